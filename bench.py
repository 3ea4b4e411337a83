"""Time the engine on the order tables and print one JSON line.

The builds of tables and of written one-row results are timed as entries of their own (``build_*``), so ``dim_*``,
``fact_sales``, ``checks_report`` and the like time the reading of what was written. ``full_run`` is the whole job from landed
files to report, checks and retention in a fresh folder, ``full_run_again`` the same as a
refresh of that folder. Every query writes all of its rows to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import retail_queries  # noqa: E402
from retail_queries import AS_OF, KEEP_DAYS, POSITION, POSITION_SCHEMA, Bench  # noqa: E402
from tallyhouse.plans import pipeline  # noqa: E402
from tallyhouse.session import build_session, new_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def passing_landing(b: Bench) -> str:
    """The landed rows that have a country: the gate refuses the load of the others, as it should."""
    path = new_folder(b.spark, "landing-passing")
    b.landed.where("trim(Country) <> ''").write.parquet(path)
    return path


def full_run(spark, in_path: str, out_dir: str) -> None:
    """The whole job from landed files to report, checks and retention."""
    pipeline.run(
        spark, in_path, out_dir, as_of=AS_OF, position=POSITION, extra=POSITION_SCHEMA, keep_days=KEEP_DAYS
    )


def main() -> None:
    spark = build_session(
        "tallyhouse-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    b = retail_queries.bench_for(spark, SF_DIR)
    timed("build_landing", lambda: b.landed_path)
    timed("build_staging", lambda: b.staging)
    timed("build_star", lambda: b.star)
    timed("build_daily", lambda: b.daily)
    for name in ("report", "metrics", "issues", "orphaned", "cleaned_stats", "summary", "gate"):
        timed(f"build_{name}", lambda name=name: getattr(b, name))
    for name, query in retail_queries.queries().items():
        timed(name, lambda query=query: run_all(query(spark, SF_DIR)))
    in_path, out_dir = passing_landing(b), new_folder(spark, "bench")
    timed("full_run", lambda: full_run(spark, in_path, out_dir))
    timed("full_run_again", lambda: full_run(spark, in_path, out_dir))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(SF_DIR).name.removeprefix("sf")),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
