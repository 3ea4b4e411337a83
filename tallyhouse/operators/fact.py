"""The sales fact: key look-ups, measures and day-grain de-duplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.retail import line_amount, returned
from tallyhouse.operators.dedup import keep_first
from tallyhouse.sources.landing import staging_valid_rows

FACT_SOURCE = (
    "invoice",
    "stock_code",
    "invoice_date",
    "quantity",
    "price",
    "customer_id",
    "country",
)
FACT_COLUMNS = (
    "invoice_no",
    "product_key",
    "customer_key",
    "time_key",
    "country_key",
    "quantity",
    "unit_price",
    "total_amount",
    "is_return",
)
# What the fact keeps of a row beside the keys of its product and customer.
LOOKED_UP = ("invoice", "time_key", "country_key", "quantity", "price", "year", "month")


def lookup(rows: DataFrame, dim: DataFrame, on: str, keep: Sequence[str], how: str) -> DataFrame:
    """Equi-join ``rows`` to a dimension on one natural key.

    No broadcast hint: dimensions are written tables, so Spark knows their size
    and broadcasts below its threshold; above it the join is a sort-merge join
    whose hot keys AQE splits on the fact side.
    """
    return rows.join(dim.select(on, *keep), on, how)


def join_product(rows: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Adds product_key; rows without a product go."""
    return lookup(rows, dim_product, "stock_code", ["product_key"], "inner")


def join_customer(rows: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Adds customer_key; rows without a customer go."""
    return lookup(rows, dim_customer, "customer_id", ["customer_key"], "inner")


def join_country(rows: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Adds country_key; null where the country is missing or unknown."""
    named = dim_country.withColumnRenamed("country_name", "country")
    return lookup(rows, named, "country", ["country_key"], "left")


def join_time(rows: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Adds time_key, year and month of the invoice day; rows without a day go."""
    dated = rows.withColumn("date_value", F.to_date("invoice_date"))
    return lookup(dated, dim_time, "date_value", ["time_key", "year", "month"], "inner")


def dedup_day(staged: DataFrame) -> DataFrame:
    """First staged line per invoice, product and day; quantities are not added up.

    Stock code and day stand for their surrogate keys one to one, so this can
    run before the look-ups and spare them the rows that go anyway.
    """
    keys = {
        "invoice": F.col("invoice"),
        "stock_code": F.col("stock_code"),
        "day": F.to_date("invoice_date"),
    }
    return keep_first(staged, keys, ["invoice_date"])


def fact_rows(
    staged: DataFrame, time, country, product, customer, step: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Fact rows, plus year and month for the table layout.

    Only what the fact is made of goes through the de-duplication: lines that
    differ in nothing else give the same fact row, whichever is kept. ``step`` gets the rows behind the
    de-duplication and behind each look-up that shuffles them where dimensions are large, and may write them.
    """
    keyed = (
        staged.transform(staging_valid_rows)
        .select(*FACT_SOURCE)
        .transform(dedup_day)
        .transform(join_time, time)
        .transform(join_country, country)
        .select(*LOOKED_UP, "stock_code", "customer_id")
        .transform(step)
        .transform(join_product, product)
        .select(*LOOKED_UP, "product_key", "customer_id")
        .transform(step)
        .transform(join_customer, customer)
        .select(*LOOKED_UP, "product_key", "customer_key")
        .transform(step)
    )
    return keyed.select(
        F.col("invoice").alias("invoice_no"),
        "product_key",
        "customer_key",
        "time_key",
        "country_key",
        "quantity",
        F.col("price").alias("unit_price"),
        line_amount(F.col("quantity"), F.col("price")).alias("total_amount"),
        returned(F.col("invoice"), F.col("quantity")).alias("is_return"),
        "year",
        "month",
    )
