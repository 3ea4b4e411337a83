"""Audit stamps: instants are kept in UTC, these only shift and format them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

# Fixed value: the warehouse shows times at UTC+8, without daylight saving.
REPORT_OFFSET_HOURS = 8


def whole_seconds(ts: Column) -> Column:
    """Zone-free timestamp cut to the second (``date_trunc`` would pass through the session zone)."""
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECOND"), ts) % 1)


def utc8(ts: Column) -> Column:
    """UTC+8 wall-clock time of a zone-free UTC timestamp, to the second."""
    return whole_seconds(ts) + F.make_dt_interval(F.lit(0), F.lit(REPORT_OFFSET_HOURS))


def file_stamp(as_of: datetime) -> str:
    """Name part of a report written at the UTC time ``as_of``: ``YYYYMMDD_HHMM`` at UTC+8."""
    return (as_of + timedelta(hours=REPORT_OFFSET_HOURS)).strftime("%Y%m%d_%H%M")


def ntz(value: datetime) -> Column:
    """Zone-free timestamp literal, independent of the session zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hours_between(earlier: Column, later: Column) -> Column:
    """Elapsed hours, counted in whole seconds; null when ``earlier`` is null."""
    return F.timestamp_diff("SECOND", earlier, later) / F.lit(3600.0)
