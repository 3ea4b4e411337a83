"""One full refresh, from landed files to report, stopped by the load gate."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyhouse.functions.stamps import file_stamp, ntz
from tallyhouse.operators.cleaning import extraction_summary
from tallyhouse.operators.integrity import orphan_counts
from tallyhouse.operators.reporting import (
    business_rules,
    data_summary,
    load_gate,
    load_warnings,
    monthly_revenue,
    quality_metrics,
    top_countries,
    top_products,
)
from tallyhouse.operators.script_checks import run_script
from tallyhouse.plans.checks import (
    checks_report_isolated,
    checks_summary,
    default_checks,
    failed_checks,
    quality_dashboard,
    quality_score,
)
from tallyhouse.plans.monitoring import daily_profile
from tallyhouse.plans.report import report_sheets, run_summary
from tallyhouse.plans.warehouse import Star, build_star, build_stats
from tallyhouse.session import materialise
from tallyhouse.sources.landing import canonical_columns, require_columns, scan_raw
from tallyhouse.sources.tables import Retained, apply_retention, load_observed, write_report

log = logging.getLogger(__name__)


class Watch:
    """Seconds that each stage of a run took, up to its mark."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self._since = time.monotonic()

    def mark(self, stage: str) -> None:
        now = time.monotonic()
        self.seconds[stage], self._since = now - self._since, now


class GateFailed(RuntimeError):
    """The load gate did not pass; nothing after it was written."""


@dataclass(frozen=True)
class Run:
    """What a full refresh wrote: every frame reads a table, none recomputes anything.

    ``sheets`` is the report, ``results`` holds the run summary, the quality
    dashboard, the top lists and the ten script checks.
    """

    staging: DataFrame
    star: Star
    daily: DataFrame
    gate: DataFrame
    checks: DataFrame
    sheets: dict[str, DataFrame]
    results: dict[str, DataFrame]
    retained: Retained | None = None


def enforce_gate(gate: DataFrame) -> None:
    """Raise unless the one-row verdict is PASS."""
    row = gate.first()
    if row["overall_status"] != "PASS":
        raise GateFailed(
            "The load gate did not pass: "
            f"integrity={row['integrity_issues']}, business={row['business_issues']}"
        )


def run(
    spark: SparkSession,
    in_path: str,
    out_dir: str,
    as_of: datetime | None = None,
    fmt: str = "parquet",
    position: Sequence[str] = (),
    extra: T.StructType | None = None,
    report_fmt: str = "parquet",
    keep_days: int = 7,
    buckets: int | None = None,
) -> Run:
    """Read ``in_path``, write staging, star schema and report below ``out_dir``.

    ``as_of`` is the run's UTC time; every age and stamp is taken against it. With ``buckets``
    staging is dealt to that many by invoice and stock code, which spares later stages a shuffle.
    """
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    raw = require_columns(canonical_columns(scan_raw(spark, in_path, fmt, extra)))
    watch = Watch()

    staging, cleaned = load_observed(raw, f"{out_dir}/raw_retail_data", as_of, position, buckets)
    log.info("Staged %d rows", staging.rows_loaded)
    if refused := staging.refused.count():
        log.warning("Staging refused %d rows; they are kept beside the table", refused)
    if not staging.rows_loaded:
        log.warning("No landed row was left after cleaning")
    watch.mark("staging")
    star = build_star(staging.frame, out_dir, as_of)
    watch.mark("star")

    issues = materialise(business_rules(star.fact, star.time, as_of.date()), "business-rules")
    orphaned = materialise(orphan_counts(star.fact, star.dimensions), "orphans")
    gate = load_gate(issues, orphaned)
    warnings = load_warnings(issues, orphaned)
    for name, rows in warnings.collect():  # at most six rows
        log.warning("%s: %d rows", name, rows)
    enforce_gate(gate)
    watch.mark("gate")

    tables = {"raw": staging.frame, "fact": star.fact, **star.dimensions}
    checked = materialise(checks_report_isolated(spark, tables, default_checks(as_of)), "checks")
    watch.mark("checks")
    daily = materialise(daily_profile(star.fact, star.time), "daily-profile")
    stamp = file_stamp(as_of)
    sheets = write_report(
        report_sheets(daily, star.fact, star.time, star.product, as_of),
        f"{out_dir}/quality_reports",
        stamp,
        report_fmt,
    )
    watch.mark("report")
    results = {
        "Run_Summary": run_summary(
            cleaned,
            data_summary(star),
            gate,
            top_countries(star.fact, star.country, 1),
            quality_score(checks_summary(checked)),
            seconds=watch.seconds,
        ),
        "Quality_Dashboard": quality_dashboard(
            checked, quality_metrics(staging.frame, star, stamps=True)
        ).withColumn("last_check_time", ntz(as_of)),
        "Checks_Report": checked.withColumn("check_time", ntz(as_of)),
        "Failed_Checks": failed_checks(checked).withColumn("check_time", ntz(as_of)),
        "Load_Warnings": warnings,
        "Extraction_Summary": extraction_summary(staging.frame),
        "Build_Stats": build_stats(staging.frame, star, as_of),
        "Top_Countries_By_Revenue": top_countries(star.fact, star.country),
        "Top_Products": top_products(star.fact, star.product),
        "Monthly_Revenue": monthly_revenue(star.fact, star.time).orderBy("year", "month"),
    }
    script = run_script(staging.frame, star.fact, star.dimensions, as_of)
    results |= {name.replace(" ", "_"): result for name, result in script.items()}
    results = write_report(results, f"{out_dir}/run_results", stamp)
    retained = None
    try:
        retained = apply_retention(
            spark, f"{out_dir}/raw_retail_data", as_of, keep_days
        )
        log.info("Retention deleted %d staged rows", retained.rows_deleted)
    except Exception:  # clean-up trouble never fails a finished run
        log.exception("Staging clean-up failed")
    return Run(staging.frame, star, daily, gate, checked, sheets, results, retained)
