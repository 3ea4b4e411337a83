"""The ten checks that run as a script: nine one-row profiles and one top list."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.frames import attach_row, side_by_side
from tallyhouse.functions.retail import HIGH_QUANTITY, cancelled
from tallyhouse.functions.stamps import hours_between, ntz
from tallyhouse.functions.stats import mean, percent
from tallyhouse.operators.dedup import distinct_keys
from tallyhouse.operators.integrity import CHECKED_DIMENSIONS, orphan_counts
from tallyhouse.session import materialise

# Fixed values of the script.
LONGEST_STOCK_CODE = 20
FIRST_DATE = datetime(2009, 1, 1)
LAST_DATE = datetime(2012, 1, 1)
ROW_KEYS = ("invoice", "stock_code", "invoice_date")


class Profile(NamedTuple):
    """Measures of one scan as one row, and columns derived from them."""

    measures: list[Column]
    derived: dict[str, Column] = {}

    def of(self, df: DataFrame) -> DataFrame:
        return df.agg(*self.measures).withColumns(self.derived)


def profiles(df: DataFrame, chosen: dict[str, Profile]) -> dict[str, DataFrame]:
    """All chosen profiles from a single scan, which is kept as one written row."""
    wide = df.agg(*[F.struct(*p.measures).alias(name) for name, p in chosen.items()])
    row = materialise(wide, "profiles")
    return {name: row.select(f"{name}.*").withColumns(p.derived) for name, p in chosen.items()}


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _null_profile() -> Profile:
    return Profile(
        [
            F.count("*").alias("total_rows"),
            _count(F.col("customer_id").isNull(), "null_customer_id"),
            _count(F.col("stock_code").isNull(), "null_stock_code"),
            _count(F.col("invoice_date").isNull(), "null_invoice_date"),
            _count(F.col("price").isNull(), "null_price"),
        ],
        {"null_customer_pct": percent(F.col("null_customer_id"), F.col("total_rows"))},
    )


def critical_nulls(raw: DataFrame) -> DataFrame:
    return _null_profile().of(raw)


def duplicates(raw: DataFrame) -> DataFrame:
    counts = raw.agg(
        F.count("*").alias("total_records"),
        distinct_keys(raw, ROW_KEYS).alias("unique_combinations"),
    )
    return counts.withColumn("duplicates", F.col("total_records") - F.col("unique_combinations"))


def _range_profile() -> Profile:
    return Profile(
        [
            F.count("*").alias("total_rows"),
            _count(F.col("price") <= 0, "invalid_price"),
            _count(F.col("quantity") > HIGH_QUANTITY, "suspicious_quantity"),
            _count(F.col("quantity") < 0, "negative_quantity"),
            _count(F.length("stock_code") > LONGEST_STOCK_CODE, "long_stock_code"),
        ]
    )


def ranges(raw: DataFrame) -> DataFrame:
    return _range_profile().of(raw)


def _return_profile() -> Profile:
    """The percentage goes by the invoice prefix alone."""
    return Profile(
        [
            F.count("*").alias("total_transactions"),
            _count(cancelled(F.col("invoice")), "return_invoices"),
            _count(F.col("quantity") < 0, "negative_quantity"),
        ],
        {"return_percentage": percent(F.col("return_invoices"), F.col("total_transactions"))},
    )


def returns(raw: DataFrame) -> DataFrame:
    return _return_profile().of(raw)


def _date_profile(first: datetime, last: datetime) -> Profile:
    day = F.col("invoice_date")
    return Profile(
        [
            F.min(day).alias("earliest_date"),
            F.max(day).alias("latest_date"),
            _count((day < ntz(first)) | (day > ntz(last)), "out_of_range_dates"),
        ]
    )


def date_range(
    raw: DataFrame, first: datetime = FIRST_DATE, last: datetime = LAST_DATE
) -> DataFrame:
    return _date_profile(first, last).of(raw)


def rows_per_country(raw: DataFrame) -> DataFrame:
    return raw.groupBy("country").agg(F.count("*").alias("n"))


def countries(raw: DataFrame) -> DataFrame:
    """Counted per country first: the distinct count then runs over one row per country."""
    return _countries(rows_per_country(raw))


def _countries(per_country: DataFrame) -> DataFrame:
    empty = F.col("country").isNull() | (F.col("country") == "")
    counts = per_country.agg(
        F.count("country").alias("unique_countries"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("null_empty_country"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
    )
    return counts.withColumn(
        "null_empty_percentage", percent(F.col("null_empty_country"), F.col("total_records"))
    )


def top_countries_share(raw: DataFrame, n: int = 10) -> DataFrame:
    """Largest countries by rows, with their share of all rows that have a country."""
    return _top_share(rows_per_country(raw.where(F.col("country").isNotNull())), n)


def _top_share(per_country: DataFrame, n: int = 10) -> DataFrame:
    per_country = per_country.where(F.col("country").isNotNull()).withColumnRenamed(
        "n", "transaction_count"
    )
    total = per_country.agg(F.sum("transaction_count").alias("total"))
    return (
        attach_row(per_country, total)
        .select(
            "country",
            "transaction_count",
            percent(F.col("transaction_count"), F.col("total")).alias("percentage"),
        )
        .orderBy(F.desc("transaction_count"), "country")
        .limit(n)
    )


def referential_integrity(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return side_by_side(
        fact.agg(F.count("*").alias("fact_records")),
        orphan_counts(fact, dims, CHECKED_DIMENSIONS),
    )


def business_logic(fact: DataFrame) -> DataFrame:
    """Exact comparison, without the tolerance the other two amount checks have."""
    amount = F.col("total_amount")
    return fact.agg(
        F.count("*").alias("total_sales"),
        _count(amount != F.col("quantity") * F.col("unit_price"), "calculation_errors"),
        mean(F.sum(amount), F.count(amount)).alias("avg_transaction_value"),
        F.max(amount).alias("max_transaction_value"),
        F.min(amount).alias("min_transaction_value"),
    )


def _freshness_profile(as_of: datetime) -> Profile:
    return Profile(
        [F.max("created_at").alias("last_loaded")],
        {"hours_since_last_load": hours_between(F.col("last_loaded"), ntz(as_of))},
    )


def freshness(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _freshness_profile(as_of).of(raw)


def run_script(
    raw: DataFrame, fact: DataFrame, dims: dict[str, DataFrame], as_of: datetime
) -> dict[str, DataFrame]:
    """All ten results by name; none is lost to a later one. The names are fixed values.

    The raw rows are read three times: for all profiles, per country, and for the distinct rows.
    """
    found = profiles(
        raw,
        {
            "nulls": _null_profile(),
            "ranges": _range_profile(),
            "returns": _return_profile(),
            "dates": _date_profile(FIRST_DATE, LAST_DATE),
            "freshness": _freshness_profile(as_of),
        },
    )
    per_country = materialise(rows_per_country(raw), "rows-per-country")
    return {
        "Critical Null Check": found["nulls"],
        "Duplicate Check": duplicates(raw),
        "Range Validation": found["ranges"],
        "Return Analysis": found["returns"],
        "Date Range Check": found["dates"],
        "Country Validation": _countries(per_country),
        "Top Countries": _top_share(per_country),
        "Referential Integrity": referential_integrity(fact, dims),
        "Business Logic Check": business_logic(fact),
        "Data Freshness": found["freshness"],
    }
