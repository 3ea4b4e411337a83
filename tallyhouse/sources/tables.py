"""Table writers and readers: staging, dimensions, fact, report sheets, retention."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallyhouse.functions.frames import stack
from tallyhouse.functions.stamps import ntz
from tallyhouse.operators.cleaning import clean, cleaning_counts, cleaning_stats, observed_stats
from tallyhouse.operators.integrity import with_refusals
from tallyhouse.operators.keys import with_dense_key
from tallyhouse.schemas import CONTRACTS, DIMENSION_KEYS, NATURAL_KEYS
from tallyhouse.session import small_splits, together
from tallyhouse.sources.landing import stage_projection
from tallyhouse.sources.versions import NO_VALUE, Buckets, VersionedTable, parts


# Where refused rows lie, and the load day of staged rows; neither is a column of the tables.
REFUSED, LOAD_DAY, LOAD_MONTH, REASONS = "refused", "load_day", "load_month", "reasons"
# What staging is grouped by after the load: day-grain de-duplication and the duplicate checks.
STAGING_BUCKETS = ("invoice", "stock_code")


@dataclass(frozen=True)
class Loaded:
    """A written table, read back; ``refused`` are the rows that broke its contract, with the reasons."""

    table: str
    rows_loaded: int
    loaded_at: datetime | None
    frame: DataFrame
    refused: DataFrame


def accepted(table: VersionedTable, number: int | None = None) -> DataFrame:
    """The rows of a table that its contract accepts."""
    rows = table.read(number, lambda p: p.get(REFUSED) != "true")
    return rows.drop(REFUSED, REASONS, LOAD_DAY, LOAD_MONTH)


def quarantine(table: VersionedTable, number: int | None = None) -> DataFrame:
    """The rows that were refused, with the reasons."""
    return table.read(number, lambda p: p.get(REFUSED) == "true").drop(REFUSED, LOAD_DAY, LOAD_MONTH)


def _split(rows: DataFrame, contract: str, dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """``rows`` with the reasons to refuse them; one write then puts both kinds into folders of their own."""
    judged = with_refusals(rows, CONTRACTS[contract], dimensions, name=REASONS)
    return judged.withColumn(REFUSED, F.size(REASONS) > 0)


def _loaded(name: str, table: VersionedTable, at: datetime | None, before: int = 0) -> Loaded:
    # A bare count of Parquet files reads footers only, and counts what was committed.
    frame = accepted(table)
    table.expire()
    return Loaded(name, frame.count() - before, at, frame, quarantine(table))


def table_exists(spark: SparkSession, path: str) -> bool:
    return VersionedTable(spark, path).version() is not None


def stage_rows(
    rows: DataFrame, path: str, unit: str = "day", buckets: int | None = None
) -> VersionedTable:
    """Replace the staging table with rows that carry ``created_at``, laid out by load day or month.

    With ``buckets`` they are dealt by invoice and stock code: one shuffle in the load, none in what groups by both.
    """
    table = VersionedTable(rows.sparkSession, path)
    period = F.trunc(F.col("created_at").cast("date"), "month") if unit == "month" else F.col("created_at").cast("date")
    split = _split(rows, "raw_retail_data").withColumn(LOAD_MONTH if unit == "month" else LOAD_DAY, period)
    dealt = Buckets(buckets, STAGING_BUCKETS) if buckets else None
    table.replace(split, (REFUSED, split.columns[-1]), dealt)
    return table


def load_staging(
    cleaned: DataFrame, path: str, as_of: datetime, buckets: int | None = None
) -> Loaded:
    """Replace the staging table with the cleaned rows, stamped with a row id and load time.

    Rows that break the contract are kept apart. Until the load is complete, readers see the table as it was.
    """
    rows = stage_projection(cleaned).select(
        (F.monotonically_increasing_id() + 1).alias("id"),
        "*",
        ntz(as_of).alias("created_at"),
    )
    with small_splits(rows.sparkSession):
        table = stage_rows(rows, path, buckets=buckets)
    return _loaded("raw_retail_data", table, as_of)


def load_observed(
    raw: DataFrame, path: str, as_of: datetime, position: Sequence[str] = (), buckets: int | None = None
) -> tuple[Loaded, DataFrame]:
    """Clean and stage ``raw`` in one pass, and the cleaning statistics of the same pass.

    The counts are observed where the rows are read. A stage that runs again counts again, so they are
    believed only if they agree with the data: the staged rows carry how many rows each stands for, and the
    sum of these, as well as their number, must be what was observed and committed. Else the rows are
    counted by a scan of their own.
    """
    seen, kept = Observation(), Observation()
    cleaned = clean(raw.observe(seen, *cleaning_counts()), position, copies="copies")
    staged = cleaned.observe(kept, F.count("*").alias("rows"), F.coalesce(F.sum("copies"), F.lit(0)).alias("copies"))
    loaded = load_staging(staged.drop("copies"), path, as_of, buckets)
    counts, written = seen.get, kept.get
    committed = loaded.rows_loaded + loaded.refused.count()
    if written["rows"] == committed and written["copies"] == counts["kept_rows"]:
        return loaded, observed_stats(raw.sparkSession, counts, loaded.rows_loaded)
    return loaded, cleaning_stats(raw, loaded.rows_loaded)


def load_dimension(
    dim: DataFrame, table: str, path: str, mode: str = "overwrite", as_of: datetime | None = None
) -> Loaded:
    """Replace or extend a dimension. Look-ups join to the table; no key map is collected.

    ``append`` adds only natural keys the table does not have, numbered on from its largest key.
    """
    spark, key, natural = dim.sparkSession, DIMENSION_KEYS[table], NATURAL_KEYS[table]
    target, before = VersionedTable(spark, path), 0
    extend = mode == "append" and target.version() is not None
    if extend:
        old = accepted(target)
        before, top = old.agg(F.count("*"), F.coalesce(F.max(key), F.lit(0))).first()
        new = dim.drop(key).join(old.select(natural), natural, "left_anti")
        numbered = with_dense_key(new, natural, key)
        dim = numbered.withColumn(key, F.col(key) + top).select(*dim.columns)
    stamps = ["created_at"] if table == "dim_time" else ["created_at", "updated_at"]
    rows = dim if as_of is None else dim.withColumns({name: ntz(as_of) for name in stamps})
    (target.append if extend else target.replace)(_split(rows, table), (REFUSED,))
    return _loaded(table, target, as_of, before)


def load_fact(
    fact: DataFrame, path: str, mode: str = "overwrite", as_of: datetime | None = None,
    dimensions: dict[str, DataFrame] | None = None,
) -> Loaded:
    """Replace or extend the fact table, laid out by year and month.

    The rebalance hint lets AQE merge small months and split large ones, so a month
    that holds a third of all rows becomes many well-sized files rather than one long
    task. An empty fact empties the table. ``append`` adds rows, ``months`` replaces the months that
    ``fact`` has rows of and leaves the files of the others as they are; both count the ids on from the largest one.
    With ``dimensions`` references are checked too; facts built by look-ups cannot break them.
    """
    target = VersionedTable(fact.sparkSession, path)
    before = top = 0
    if mode != "overwrite" and target.version() is not None:
        before, top = accepted(target).agg(F.count("*"), F.coalesce(F.max("sale_id"), F.lit(0))).first()
    # The row id is unique, not gapless: nothing but uniqueness is ever asked of it.
    rows = _split(fact, "fact_sales", dimensions).hint("rebalance", "year", "month").withColumn(
        "sale_id", F.monotonically_increasing_id() + 1 + top
    )
    if as_of is not None:
        rows = rows.withColumn("created_at", ntz(as_of))
    months = partial(target.replace_parts, on=("year", "month"))
    change = {"overwrite": target.replace, "append": target.append, "months": months}[mode]
    with small_splits(fact.sparkSession):
        change(rows, (REFUSED, "year", "month"))
    return _loaded("fact_sales", target, as_of, before if mode == "append" else 0)


@dataclass(frozen=True)
class Retained:
    """Staging after retention."""

    frame: DataFrame
    rows_deleted: int


def _is_stale(as_of: datetime, keep_days: int) -> Column:
    """Older than the retention period; null (so never deleted) without a stamp."""
    return F.col("created_at") < ntz(as_of - timedelta(days=keep_days))


def retention_split(staged: DataFrame, as_of: datetime, keep_days: int = 7) -> DataFrame:
    """One row: how many rows retention deletes and keeps."""
    deleted = F.count_if(_is_stale(as_of, keep_days))
    return staged.agg(
        deleted.alias("rows_deleted"), (F.count("*") - deleted).alias("rows_kept")
    )


def _period(folder: str) -> tuple[datetime, datetime] | None:
    """First moment of a staging folder's load period, and the first after it; none without a stamp."""
    found = {k: v for k, v in parts(folder).items() if k in (LOAD_DAY, LOAD_MONTH) and v != NO_VALUE}
    if not found:
        return None
    (unit, first), = found.items()
    start = datetime.fromisoformat(first)
    return start, (start + timedelta(days=31)).replace(day=1) if unit == LOAD_MONTH else start + timedelta(days=1)


def apply_retention(
    spark: SparkSession, path: str, as_of: datetime, keep_days: int = 7
) -> Retained:
    """Drop the stale rows of the staging table at ``path`` from that table.

    Load periods that are stale as a whole leave the table as folders. Only the period that the limit falls
    into is written again, without its stale rows; all other files stay the same. Refused rows expire alike,
    but are not counted.
    """
    table, limit = VersionedTable(spark, path), as_of - timedelta(days=keep_days)
    version = table.version()
    periods = {folder: _period(folder) for folder in version.folders}
    stale = [f for f, p in periods.items() if p and p[1] <= limit]
    split = [f for f, p in periods.items() if p and p[0] < limit < p[1]]
    kept = table.read_folders(version, split).where(~F.coalesce(_is_stale(as_of, keep_days), F.lit(False)))
    before = accepted(table).count()
    if split and not table.read_folders(version, split).where(_is_stale(as_of, keep_days)).limit(1).count():
        split = []
    if stale or split:
        by = [name for name in (REFUSED, LOAD_DAY, LOAD_MONTH) if name in version.schema.names]
        new = table.write(kept, by, version.buckets) if split else ()
        left = [f for f in version.folders if f not in stale + split] + list(new)
        table.commit(version.schema, left, version.buckets)
        table.expire()
    left = accepted(table)
    return Retained(left, before - left.count())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``(table_name, row_count)`` row per table."""
    return stack(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def write_report(
    sheets: dict[str, DataFrame], out_dir: str, stamp: str, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Write every sheet to ``out_dir/report_ts=<stamp>/<sheet>`` and return what was written."""
    options = {"header": True} if fmt == "csv" else {}

    def write(name: str, sheet: DataFrame) -> DataFrame:
        path = f"{out_dir}/report_ts={stamp}/{name}"
        sheet.write.mode("overwrite").options(**options).format(fmt).save(path)
        reader = sheet.sparkSession.read.schema(sheet.schema).options(**options)
        return reader.format(fmt).load(path)

    return together(**{n: partial(write, n, sheet) for n, sheet in sheets.items()})


def report_manifest(written: dict[str, DataFrame]) -> DataFrame:
    """Sheets of a report with their row counts."""
    return row_counts(written).select(
        F.col("table_name").alias("sheet"), F.col("row_count").alias("rows")
    )
