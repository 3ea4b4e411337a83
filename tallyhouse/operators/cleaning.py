"""Cleaning of the raw transactions, and what cleaning did."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.frames import side_by_side
from tallyhouse.functions.retail import bad_price, high_quantity, line_amount, returned
from tallyhouse.functions.stamps import ntz
from tallyhouse.functions.stats import percent
from tallyhouse.operators.dedup import distinct_keys, keep_first
from tallyhouse.schemas import CRITICAL_COLUMNS, SOURCE_KEYS
from tallyhouse.sources.landing import require_columns


def _complete() -> Column:
    """All critical fields present, as conditions that reach the Parquet reader."""
    return reduce(and_, [F.col(name).isNotNull() for name in CRITICAL_COLUMNS])


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return df.where(_complete())


def flag_price(df: DataFrame) -> DataFrame:
    return df.withColumn("price_flag", bad_price(F.col("UnitPrice")))


def flag_quantity(df: DataFrame) -> DataFrame:
    return df.withColumn("quantity_flag", high_quantity(F.col("Quantity")))


def flag_returns(df: DataFrame) -> DataFrame:
    return df.withColumn("is_return", returned(F.col("InvoiceNo"), F.col("Quantity")))


def add_line_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("TotalAmount", line_amount(F.col("Quantity"), F.col("UnitPrice")))


def dedup_source(df: DataFrame, position: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """First line per invoice, stock code and time; ``position`` gives the source order."""
    return keep_first(df, SOURCE_KEYS, position, copies)


def clean(
    raw: DataFrame, position: Sequence[str] = (), processed_at: datetime | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Canonical raw rows to flagged, de-duplicated rows with their amounts.

    ``copies`` names a further column with the number of complete rows that a row stands for.

    The flags and the amount follow from the surviving row alone, so they are
    added after de-duplication and do not travel through its shuffle.
    """
    cleaned = (
        require_columns(raw)
        .transform(drop_critical_nulls)
        .transform(dedup_source, position, copies)
        .transform(flag_price)
        .transform(flag_quantity)
        .transform(flag_returns)
        .transform(add_line_amount)
    )
    if processed_at is None:
        return cleaned
    return cleaned.withColumn("processed_at", ntz(processed_at))


def cleaning_counts() -> list[Column]:
    """What cleaning counts on the raw rows: aggregates that also work as observed metrics."""
    complete, invoice, quantity = _complete(), F.col("InvoiceNo"), F.col("Quantity")
    return [
        F.count("*").alias("initial_rows"),
        F.count_if(complete).alias("kept_rows"),
        F.count_if(complete & bad_price(F.col("UnitPrice"))).alias("invalid_price_count"),
        F.count_if(complete & high_quantity(quantity)).alias("high_quantity_count"),
        F.count_if(complete & returned(invoice, quantity)).alias("return_count"),
    ]


def cleaning_stats(raw: DataFrame, final_rows: int | None = None) -> DataFrame:
    """One row of counts. The flags are counted before duplicates go, as cleaning defines them.

    The counts need no shuffle. The surviving rows are the distinct source keys,
    for which only the key columns are read and shuffled; a caller that has just
    loaded the staging table knows their number and passes it.
    """
    totals = require_columns(raw).agg(*cleaning_counts())
    if final_rows is not None:
        totals = totals.withColumn("final_rows", F.lit(final_rows).cast("long"))
    else:
        kept = drop_critical_nulls(raw)
        unique = kept.agg(distinct_keys(kept, SOURCE_KEYS).alias("final_rows"))
        totals = side_by_side(totals, unique)
    return _stats(totals)


def observed_stats(spark: SparkSession, counts: dict[str, int], final_rows: int) -> DataFrame:
    """The same row from counts that were observed while the rows were loaded."""
    schema = T.StructType([T.StructField(name, T.LongType()) for name in (*counts, "final_rows")])
    return _stats(spark.createDataFrame([(*counts.values(), final_rows)], schema))


def _stats(totals: DataFrame) -> DataFrame:
    dropped = F.col("initial_rows") - F.col("final_rows")
    return totals.select(
        (F.col("initial_rows") - F.col("kept_rows")).alias("null_drops"),
        "invalid_price_count",
        "high_quantity_count",
        "return_count",
        (F.col("kept_rows") - F.col("final_rows")).alias("duplicates_removed"),
        "initial_rows",
        "final_rows",
        dropped.alias("rows_dropped"),
        percent(dropped, F.col("initial_rows")).alias("drop_rate"),
    )


def extraction_summary(staged: DataFrame) -> DataFrame:
    """One row over the staging table, which is read once: size, date range, distinct members, last load.

    A row gives one entry per member column, and tasks merge equal members before they are shuffled. The customer
    entries, of which each row has one, also carry what is counted over rows.
    """
    members = {"customer_id": "unique_customers", "stock_code": "unique_products", "country": "unique_countries"}
    entries = F.array(
        *[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("member")) for c in members]
    )
    merged = (
        staged.select(F.inline(entries), "invoice_date", "created_at")
        .groupBy("kind", "member")
        .agg(
            F.count("*").alias("rows"),
            F.min("invoice_date").alias("earliest"),
            F.max("invoice_date").alias("latest"),
            F.max("created_at").alias("loaded"),
        )
    )
    return merged.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "customer_id", F.col("rows"))), F.lit(0)).alias("total_rows"),
        F.min("earliest").alias("earliest_date"),
        F.max("latest").alias("latest_date"),
        F.max("loaded").alias("last_load_time"),
        *[
            F.count_if((F.col("kind") == column) & F.col("member").isNotNull()).alias(name)
            for column, name in members.items()
        ],
    )
