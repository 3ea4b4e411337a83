"""Statistical monitoring: daily sales, customer gaps, return rates, products.

The day-level results all start from :func:`daily_profile`, which reads the fact
once. Write it with :func:`tallyhouse.session.materialise` before deriving from
it: global statistics then read a few thousand days, not the fact again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.frames import attach_row, side_by_side
from tallyhouse.functions.stats import band, percent, z_score
from tallyhouse.operators.reporting import sent_back, sold

# Fixed values of the monitoring rules.
FENCE_FACTOR = 1.5
OUTLIER_SCORE = 85
FULL_SCORE = 100
MISSING_LIMIT = 5.0
LOWEST_CUSTOMER_SCORE = 50.0
ANOMALY_Z = 2
SHORTEST_STOCK_CODE = 3


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def daily_profile(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Everything monitoring needs to know about a day that has sales.

    Aggregated by time key before the calendar joins. The distinct customers make
    Spark pre-aggregate by (day, customer), so one dominant day is spread too.
    """
    per_day = fact.groupBy("time_key").agg(
        F.count("*").alias("total_transactions"),
        F.count("customer_key").alias("transactions_with_customer"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.count_if("is_return").alias("return_transactions"),
        _or_zero(F.sum(sold())).alias("daily_sales"),
        _or_zero(F.sum(F.when(F.col("is_return"), F.col("total_amount")))).alias("daily_returns"),
        _or_zero(F.sum(sent_back())).alias("return_amount"),
    )
    days = dim_time.select("time_key", "date_value", "year", "month", "day_name", "is_weekend")
    return days.join(per_day, "time_key").drop("time_key")


def line_profile(lines: DataFrame) -> DataFrame:
    """Rows and known customers per day of any line-level frame, such as the uncleaned lines."""
    per_day = (
        lines.where(F.col("invoice_date").isNotNull())
        .groupBy(F.to_date("invoice_date").alias("date_value"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.count("customer_id").alias("transactions_with_customer"),
        )
    )
    return per_day.select(
        "date_value",
        F.year("date_value").alias("year"),
        F.month("date_value").alias("month"),
        "total_transactions",
        "transactions_with_customer",
    )


def data_date_range(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """First, last and number of days that have facts."""
    used = fact.select("time_key").distinct()
    days = dim_time.select("time_key", "date_value").join(used, "time_key", "left_semi")
    return days.agg(
        F.min("date_value").alias("min_date"),
        F.max("date_value").alias("max_date"),
        F.count_distinct("date_value").alias("total_days"),
    )


def iqr_fences(daily: DataFrame) -> DataFrame:
    """One row: quartiles by linear interpolation, fences, mean and deviation of daily sales.

    The exact percentile holds one entry per distinct value; there is one value
    per calendar day.
    """
    sales = F.col("daily_sales").cast("double")
    stats = daily.agg(
        F.percentile(sales, F.array(F.lit(0.25), F.lit(0.75))).alias("quartiles"),
        F.avg(sales).alias("mean_sales"),
        F.stddev_samp(sales).alias("std_sales"),
    ).select(
        F.get("quartiles", F.lit(0)).alias("q25"),
        F.get("quartiles", F.lit(1)).alias("q75"),
        "mean_sales",
        "std_sales",
    )
    spread = F.col("q75") - F.col("q25")
    return stats.select(
        "q25",
        "q75",
        spread.alias("iqr"),
        (F.col("q25") - FENCE_FACTOR * spread).alias("lower_bound"),
        (F.col("q75") + FENCE_FACTOR * spread).alias("upper_bound"),
        "mean_sales",
        "std_sales",
    )


def daily_sales_range(daily: DataFrame) -> DataFrame:
    """Daily sales with outlier verdict, score and z-score."""
    sales = F.col("daily_sales").cast("double")
    kind = band(sales, F.col("lower_bound"), F.col("upper_bound"))
    return attach_row(daily, iqr_fences(daily)).select(
        "date_value",
        "year",
        "month",
        "day_name",
        "is_weekend",
        "daily_sales",
        "total_transactions",
        "unique_customers",
        "daily_returns",
        "return_transactions",
        (kind != "Normal").alias("is_outlier"),
        kind.alias("outlier_type"),
        F.when(kind != "Normal", OUTLIER_SCORE).otherwise(FULL_SCORE).alias("quality_score"),
        "mean_sales",
        "std_sales",
        z_score(sales, F.col("mean_sales"), F.col("std_sales")).alias("z_score"),
    )


def missing_customer_rate(daily: DataFrame) -> DataFrame:
    """Share of rows without a customer per day, with status and score."""
    missing = F.col("total_transactions") - F.col("transactions_with_customer")
    rate = F.col("missing_customer_rate")
    return daily.select(
        "date_value",
        "year",
        "month",
        "total_transactions",
        "transactions_with_customer",
        missing.alias("missing_customers"),
        percent(missing, F.col("total_transactions")).alias("missing_customer_rate"),
    ).withColumns(
        {
            "quality_status": F.when(rate <= MISSING_LIMIT, "Good")
            .when(rate <= MISSING_LIMIT * 2, "Warning")
            .otherwise("Critical"),
            "quality_score": F.when(rate <= MISSING_LIMIT, float(FULL_SCORE)).otherwise(
                F.greatest(
                    F.lit(LOWEST_CUSTOMER_SCORE), FULL_SCORE - (rate - MISSING_LIMIT) * 10
                )
            ),
        }
    )


def return_rate_analysis(daily: DataFrame) -> DataFrame:
    """Daily return rate with z-score, anomaly flag and one-sigma status."""
    rates = daily.select(
        "date_value",
        "year",
        "month",
        "total_transactions",
        "return_transactions",
        percent(F.col("return_transactions"), F.col("total_transactions")).alias("return_rate"),
        F.col("daily_sales").alias("sales_amount"),
        "return_amount",
    )
    stats = rates.agg(
        F.avg("return_rate").alias("centre"), F.stddev_samp("return_rate").alias("spread")
    )
    rate, centre, spread = F.col("return_rate"), F.col("centre"), F.col("spread")
    z = z_score(rate, centre, spread)
    return attach_row(rates, stats).select(
        *rates.columns,
        z.alias("return_rate_z_score"),
        F.coalesce(F.abs(z) > ANOMALY_Z, F.lit(False)).alias("is_return_anomaly"),
        F.when(spread > 0, band(rate, centre - spread, centre + spread))
        .otherwise("Normal")
        .alias("return_status"),
    )


def product_quality(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales and completeness per product; products without sales stay in."""
    totals = fact.groupBy("product_key").agg(
        F.count("*").alias("transaction_count"), F.sum("total_amount").alias("total_revenue")
    )
    no_text = F.coalesce(F.col("description") == "", F.lit(True)).cast("int")
    short = (F.length("stock_code") < SHORTEST_STOCK_CODE).cast("int")
    issues = F.col("missing_description") + F.col("invalid_stock_code")
    return (
        dim_product.select("product_key", "stock_code", "description")
        .join(totals, "product_key", "left")
        .select(
            "stock_code",
            "description",
            _or_zero(F.col("transaction_count")).alias("transaction_count"),
            "total_revenue",
            no_text.alias("missing_description"),
            short.alias("invalid_stock_code"),
        )
        .withColumns(
            {
                "quality_issues": issues,
                "quality_score": F.when(issues == 0, FULL_SCORE).when(issues == 1, 75).otherwise(50),
            }
        )
    )


def overall_summary(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """One row over the whole fact, which is read once.

    Surrogate keys are dense, so distinct ones are counted by bitmaps: a fact row gives one entry for its day,
    which also carries the amounts, and one each for its customer and its product, and tasks merge the bits of
    64 neighbouring keys in one number before they are shuffled. Numbers as buffers let Spark merge them in a hash
    table, which holds one entry per day and per 64 keys; bitmaps in binary would make it sort every entry. What is
    left is a row per day and per 64 keys.
    """
    is_day = F.col("kind") == "day"
    entries = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                # A day is a group of its own; other keys share the bitmap of their neighbours.
                (F.col(key) if kind == "day" else F.shiftright(key, 6)).alias("part"),
                F.col(key).bitwiseAND(63).cast("int").alias("bit"),
            )
            for kind, key in (("day", "time_key"), ("customer", "customer_key"), ("product", "product_key"))
        ]
    )
    merged = (
        fact.select(F.inline(entries), sold().alias("sold"), sent_back().alias("sent_back"), "is_return")
        .groupBy("kind", "part")
        .agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"),
            F.count_if(is_day).alias("rows"),
            F.count_if(is_day & F.col("is_return")).alias("returned"),
            F.sum(F.when(is_day, F.col("sold"))).alias("sold"),
            F.sum(F.when(is_day, F.col("sent_back"))).alias("sent_back"),
        )
    )
    days = dim_time.select(F.lit("day").alias("kind"), F.col("time_key").alias("part"), "date_value")
    members = lambda kind: _or_zero(
        F.sum(F.when(F.col("kind") == kind, F.bit_count("bits")))
    )
    return merged.join(days, ["kind", "part"], "left").agg(
        F.min("date_value").alias("min_date"),
        F.max("date_value").alias("max_date"),
        F.count_distinct("date_value").alias("total_days"),
        _or_zero(F.sum("rows")).alias("total_records"),
        _or_zero(F.sum("sold")).cast("double").alias("total_sales"),
        _or_zero(F.sum("sent_back")).cast("double").alias("total_returns"),
        F.coalesce(percent(F.sum("returned"), F.sum("rows")), F.lit(0.0)).alias("overall_return_rate"),
        members("customer").alias("unique_customers"),
        members("product").alias("unique_products"),
        F.count_if(is_day & F.col("part").isNotNull()).alias("unique_dates"),
    )


def anomaly_details(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Outlier days and return-rate anomalies as one list."""
    outliers = sales.where("is_outlier").select(
        F.col("date_value").alias("Date"),
        F.lit("Sales Outlier").alias("Issue_Type"),
        F.when(F.col("outlier_type") == "Low", "Medium").otherwise("High").alias("Severity"),
        F.col("daily_sales").cast("double").alias("Value"),
        F.concat("outlier_type", F.lit(" sales day: $"), F.format_number("daily_sales", 2)).alias(
            "Description"
        ),
    )
    odd_returns = returns.where("is_return_anomaly").select(
        F.col("date_value").alias("Date"),
        F.lit("Return Rate Anomaly").alias("Issue_Type"),
        F.lit("Medium").alias("Severity"),
        F.col("return_rate").alias("Value"),
        F.concat(
            F.lit("Unusual return rate: "), F.col("return_rate").cast("string"), F.lit("%")
        ).alias("Description"),
    )
    return outliers.unionByName(odd_returns)


def monthly_trends(sales: DataFrame) -> DataFrame:
    """Daily rows by month; totals and averages are exact decimals rounded once."""
    days = F.count("daily_sales")
    score = F.sum("quality_score").cast("decimal(20,0)")
    return sales.groupBy("year", "month").agg(
        F.sum("daily_sales").alias("Total_Sales"),
        F.round(F.sum("daily_sales") / days, 2).alias("Avg_Daily_Sales"),
        days.alias("Days_Count"),
        F.round(score / F.count("quality_score"), 2).alias("Avg_Quality_Score"),
        F.sum("total_transactions").alias("Total_Transactions"),
    )


def monitoring_counters(
    sales: DataFrame, customers: DataFrame, returns: DataFrame, products: DataFrame
) -> DataFrame:
    """One row: how many days and products need attention."""
    return side_by_side(
        sales.agg(F.count_if("is_outlier").alias("outlier_days")),
        customers.agg(F.count_if(F.col("quality_status") == "Critical").alias("critical_days")),
        returns.agg(F.count_if("is_return_anomaly").alias("return_anomaly_days")),
        products.agg(
            F.count_if(F.col("quality_score") < FULL_SCORE).alias("products_with_issues")
        ),
    )
