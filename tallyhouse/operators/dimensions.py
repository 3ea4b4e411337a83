"""Dimension rows, without their surrogate keys, from the staged transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.schemas import STAGING
from tallyhouse.session import materialise

# Monday is day 1, the weekend is Saturday and Sunday.
WEEKEND = (6, 7)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of ``date_value``."""
    day = F.col("date_value")
    day_of_week = F.weekday(day) + 1
    return days.select(
        "date_value",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.dayofmonth(day).alias("day_of_month"),
        day_of_week.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        day_of_week.isin(*WEEKEND).alias("is_weekend"),
    )


def time_rows(staged: DataFrame) -> DataFrame:
    """One row per day that occurs in the data."""
    days = staged.select(F.to_date("invoice_date").alias("date_value"))
    return calendar(days.dropna().distinct())


def country_rows(staged: DataFrame) -> DataFrame:
    return staged.select(F.col("country").alias("country_name")).dropna().distinct()


def product_rows(staged: DataFrame) -> DataFrame:
    """One row per stock code with its most frequent description.

    Ties go to the smallest text, and null only wins when there is nothing else.
    Counting (code, description) pairs first keeps every step a plain partial
    aggregate, also for a code with a third of the rows or very many descriptions.
    """
    pairs = (
        staged.where(F.col("stock_code").isNotNull())
        .groupBy("stock_code", "description")
        .agg(F.count("*").alias("uses"))
    )
    ranked = F.struct(
        F.col("description").isNull().alias("missing"),
        (-F.col("uses")).alias("rank"),
        F.col("description").alias("description"),
    )
    best = pairs.groupBy("stock_code").agg(F.min(ranked).alias("best"))
    return best.select("stock_code", F.col("best.description").alias("description"))


def customer_rows(staged: DataFrame, countries: DataFrame) -> DataFrame:
    """One row per customer with the country (key) of the customer's first row.

    Rows are ordered by date (none comes first), then by the other staged columns. Only customers with several
    countries on their first date need the other columns: the earliest date per customer and country is merged in
    a hash table and shuffles narrow, and the rows of the few others are read again. Both steps are written, so
    that Spark knows how few they are before it joins.
    """
    tie_break = [
        name for name in STAGING.names if name not in ("invoice_date", "customer_id", "country")
    ]
    usable = staged.where(F.col("customer_id").isNotNull())
    undated = F.col("undated")
    per_country = usable.groupBy("customer_id", "country").agg(
        F.bool_or(F.col("invoice_date").isNull()).alias("undated"), F.min("invoice_date").alias("first")
    )
    # At most one entry per country, so the lists stay short.
    entry = F.struct((~undated).alias("dated"), F.when(~undated, F.col("first")).alias("first"), "country")
    found = per_country.groupBy("customer_id").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    best, next_one = F.col("found")[0], F.get("found", F.lit(1))
    tied = (F.size("found") > 1) & (best["dated"] == next_one["dated"]) & best["first"].eqNullSafe(next_one["first"])
    firsts = materialise(
        found.select("customer_id", best["country"].alias("country_name"), best["first"].alias("first"), tied.alias("tied")),
        "customer-firsts",
    )
    several = materialise(firsts.where("tied").select("customer_id", "first"), "customer-ties")
    decided = (
        usable.join(several, "customer_id")
        .where(F.col("invoice_date").eqNullSafe(F.col("first")))
        .groupBy("customer_id")
        .agg(F.min_by("country", F.struct(*tie_break, "country")).alias("country_name"))
    )
    told = firsts.where("NOT tied").select("customer_id", "country_name").unionByName(decided)
    known = countries.select("country_name", "country_key")
    return told.join(known, "country_name", "left").select("customer_id", "country_key")
