"""Command line: one full refresh, then its verdicts and counters.

``python -m tallyhouse IN_DIR OUT_DIR [--format csv] [--as-of 2011-12-10T02:00:00]``
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime

from pyspark.sql import types as T

from tallyhouse.plans import monitoring, pipeline
from tallyhouse.session import build_session, measured_bytes, remove_scratch, sizing


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyhouse", description=__doc__)
    parser.add_argument("in_dir", help="landed transaction files")
    parser.add_argument("out_dir", help="folder for tables and reports")
    parser.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    parser.add_argument("--report-format", default="csv", choices=("parquet", "csv"))
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="UTC time of the run")
    parser.add_argument("--keep-days", type=int, default=7, help="staging retention")
    parser.add_argument("--position", help="landed whole-number column that gives the source order")
    parser.add_argument("--buckets", type=int, help="deal staging to so many buckets by invoice and stock code")
    return parser.parse_args(argv)


# Results of one row, and rankings with a length of their own; the rest is in the folder.
_SHOWN = ("Run_Summary", "Quality_Dashboard", "Load_Warnings", "Build_Stats", "Top_Countries_By_Revenue", "Top_Products")


def _show(title: str, df) -> None:
    print(f"\n{title}")
    df.show(truncate=False, vertical=len(df.columns) > 6)


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session()
    for name, value in sizing(measured_bytes(spark, args.in_dir)).items():
        spark.conf.set(name, value)
    extra = T.StructType([T.StructField(args.position, T.LongType())]) if args.position else None
    try:
        done = pipeline.run(
            spark,
            args.in_dir,
            args.out_dir,
            args.as_of,
            args.format,
            position=[args.position] if args.position else (),
            extra=extra,
            report_fmt=args.report_format,
            keep_days=args.keep_days,
            buckets=args.buckets,
        )
    except pipeline.GateFailed as failure:
        print(failure, file=sys.stderr)
        return 1
    _show(
        "Monitoring counters",
        monitoring.monitoring_counters(
            monitoring.daily_sales_range(done.daily),
            monitoring.missing_customer_rate(done.daily),
            monitoring.return_rate_analysis(done.daily),
            monitoring.product_quality(done.star.fact, done.star.product),
        ),
    )
    for name in _SHOWN:
        _show(name, done.results[name])
    print(f"\nAll {len(done.results)} results: {args.out_dir}/run_results")
    remove_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
