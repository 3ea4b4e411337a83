"""Business aggregates over the star schema.

Every per-dimension total is built on the surrogate key first; the dimension's
names join to the few totals, not to the fact rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.frames import side_by_side
from tallyhouse.functions.retail import EXTREME_QUANTITY, amount_is_off
from tallyhouse.functions.stats import percent


def sold(value: str = "total_amount") -> Column:
    return F.when(~F.col("is_return"), F.col(value))


def sent_back(value: str = "total_amount") -> Column:
    return F.when(F.col("is_return"), F.abs(F.col(value)))


def business_rules(fact: DataFrame, dim_time: DataFrame, as_of: date) -> DataFrame:
    """One row: rule violations and the sales and return totals (0 when there are none)."""
    per_day = fact.groupBy("time_key").agg(
        F.count("*").alias("n"),
        F.count_if(
            amount_is_off(F.col("total_amount"), F.col("quantity"), F.col("unit_price"))
        ).alias("off"),
        F.count_if((F.col("quantity") < 0) & ~F.col("is_return")).alias("negative"),
        F.count_if(F.col("unit_price") <= 0).alias("zero_price"),
        F.count_if(F.abs(F.col("quantity")) > EXTREME_QUANTITY).alias("extreme"),
        F.sum(sold()).alias("sales"),
        F.sum(sent_back()).alias("returns"),
    )
    days = dim_time.select("time_key", "date_value")
    dated = per_day.join(days, "time_key", "left")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return dated.agg(
        total("off").alias("calculation_errors"),
        total("negative").alias("negative_quantities_non_returns"),
        total("zero_price").alias("zero_unit_price"),
        total("extreme").alias("extreme_quantities"),
        F.coalesce(F.sum(F.when(F.col("date_value") > F.lit(as_of), F.col("n"))), F.lit(0)).alias(
            "future_dates"
        ),
        F.coalesce(F.sum("sales").cast("double"), F.lit(0.0)).alias("total_sales_amount"),
        F.coalesce(F.sum("returns").cast("double"), F.lit(0.0)).alias("total_returns_amount"),
    )


def data_summary(star) -> DataFrame:
    """One row: sizes, date range, revenue, returns. Sums stay null on an empty fact."""
    facts = star.fact.agg(
        F.count("*").alias("total_transactions"),
        F.sum(sold()).alias("total_revenue"),
        F.sum(sent_back()).alias("total_returns"),
        F.count_if("is_return").alias("returned_rows"),
    ).select(
        "total_transactions",
        "total_revenue",
        "total_returns",
        percent(F.col("returned_rows"), F.col("total_transactions")).alias("return_rate"),
    )
    return side_by_side(
        facts,
        star.customer.agg(F.count("*").alias("unique_customers")),
        star.product.agg(F.count("*").alias("unique_products")),
        star.country.agg(F.count("*").alias("unique_countries")),
        star.time.agg(
            F.min("date_value").alias("date_range_start"),
            F.max("date_value").alias("date_range_end"),
        ),
    )


def top_countries(fact: DataFrame, dim_country: DataFrame, n: int = 5) -> DataFrame:
    totals = (
        fact.where(~F.col("is_return"))
        .groupBy("country_key")
        .agg(F.sum("total_amount").alias("revenue"))
    )
    named = totals.join(dim_country.select("country_key", "country_name"), "country_key")
    return (
        named.select("country_name", "revenue")
        .orderBy(F.desc("revenue"), "country_name")
        .limit(n)
    )


def top_products(fact: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    totals = (
        fact.where(~F.col("is_return"))
        .groupBy("product_key")
        .agg(F.sum("quantity").alias("total_quantity"))
    )
    named = totals.join(
        dim_product.select("product_key", "stock_code", "description"), "product_key"
    )
    return (
        named.select("stock_code", "description", "total_quantity")
        .orderBy(F.desc("total_quantity"), "stock_code")
        .limit(n)
    )


def monthly_revenue(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Non-return revenue by month; sort where it is shown or written."""
    totals = (
        fact.where(~F.col("is_return"))
        .groupBy("time_key")
        .agg(F.sum("total_amount").alias("revenue"))
    )
    dated = totals.join(dim_time.select("time_key", "year", "month"), "time_key")
    return dated.groupBy("year", "month").agg(F.sum("revenue").alias("monthly_revenue"))


def quality_metrics(raw: DataFrame, star, stamps: bool = False) -> DataFrame:
    """One row of sizes and averages; ``stamps`` adds the last load times."""
    counts = [F.count("*").alias("raw_data_count"), F.count_distinct("customer_id").alias("unique_customers_raw")]
    facts = [
        F.count("*").alias("fact_sales_count"),
        F.count_if("is_return").alias("return_transactions"),
        F.round(F.try_divide(F.sum(sold()), F.count(sold())), 2).alias("avg_transaction_value"),
        F.sum(sold()).alias("total_revenue"),
    ]
    if stamps:
        counts.append(F.max("created_at").alias("last_raw_load"))
        facts.append(F.max("created_at").alias("last_warehouse_load"))
    return side_by_side(
        raw.agg(*counts),
        star.fact.agg(*facts),
        star.customer.agg(F.count("*").alias("dim_customers_count")),
        star.product.agg(F.count("*").alias("dim_products_count")),
        star.country.agg(F.count("*").alias("dim_countries_count")),
    )


def load_gate(fact_issues: DataFrame, orphan_row: DataFrame) -> DataFrame:
    """One row with the verdict: orphans and broken rules fail, odd prices and sizes do not."""
    integrity = (
        F.col("orphaned_products")
        + F.col("orphaned_customers")
        + F.col("orphaned_times")
        + F.col("orphaned_countries")
    )
    business = (
        F.col("calculation_errors")
        + F.col("negative_quantities_non_returns")
        + F.col("future_dates")
    )
    return side_by_side(fact_issues, orphan_row).select(
        integrity.alias("integrity_issues"),
        business.alias("business_issues"),
        F.when((integrity > 0) | (business > 0), "FAIL").otherwise("PASS").alias("overall_status"),
    )


WARNING_NAMES = (
    "orphaned_products",
    "orphaned_customers",
    "orphaned_times",
    "orphaned_countries",
    "zero_unit_price",
    "extreme_quantities",
)


def load_warnings(fact_issues: DataFrame, orphan_row: DataFrame) -> DataFrame:
    """One ``(check_name, row_count)`` row per non-zero orphan, price or size count."""
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(name).alias("row_count"))
            for name in WARNING_NAMES
        ]
    )
    return side_by_side(fact_issues, orphan_row).select(F.inline(rows)).where("row_count > 0")
