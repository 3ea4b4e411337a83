"""Ratios, scores and bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` rounded half up in decimals; null when ``whole`` is 0."""
    share = F.try_divide(part * F.lit(100).cast("decimal(4,1)"), whole)
    return F.round(share, digits).cast("double")


def mean(total: Column, rows: Column) -> Column:
    """Average as one double division of an exact total; null without rows."""
    return F.try_divide(total.cast("double"), rows.cast("double"))


def z_score(value: Column, centre: Column, spread: Column) -> Column:
    """Distance from the mean in standard deviations; null when the spread is null or 0."""
    return F.try_divide(value - centre, spread)


def band(value: Column, low: Column, high: Column) -> Column:
    """Low / High outside the open limits, Normal inside them or when a limit is null."""
    return F.when(value < low, "Low").when(value > high, "High").otherwise("Normal")
