"""Report sheets and the run summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.frames import side_by_side
from tallyhouse.functions.stamps import ntz, utc8
from tallyhouse.plans import monitoring


def sheet_daily_quality_metrics(sales: DataFrame) -> DataFrame:
    return sales.select(
        "date_value",
        "daily_sales",
        "total_transactions",
        "unique_customers",
        "is_outlier",
        "outlier_type",
        "quality_score",
        "z_score",
    )


def sheet_customer_data_quality(customers: DataFrame) -> DataFrame:
    return customers.select(
        "date_value",
        "total_transactions",
        "missing_customers",
        "missing_customer_rate",
        "quality_status",
        "quality_score",
    )


def sheet_return_rate_analysis(returns: DataFrame) -> DataFrame:
    return returns.select(
        "date_value",
        "total_transactions",
        "return_transactions",
        "return_rate",
        "return_rate_z_score",
        "is_return_anomaly",
        "return_status",
    )


def sheet_product_quality(products: DataFrame) -> DataFrame:
    """All products, those with the highest revenue first."""
    return products.select(
        "stock_code",
        "description",
        "transaction_count",
        "total_revenue",
        "missing_description",
        "invalid_stock_code",
        "quality_score",
    ).orderBy(F.desc_nulls_last("total_revenue"), "stock_code")


def report_sheets(
    daily: DataFrame, fact: DataFrame, dim_time: DataFrame, dim_product: DataFrame, as_of: datetime
) -> dict[str, DataFrame]:
    """The seven sheets by name, in reading order. ``daily`` is a written daily profile."""
    sales = monitoring.daily_sales_range(daily)
    customers = monitoring.missing_customer_rate(daily)
    returns = monitoring.return_rate_analysis(daily)
    products = monitoring.product_quality(fact, dim_product)
    summary = monitoring.overall_summary(fact, dim_time)
    stamp = F.date_format(utc8(ntz(as_of)), "yyyy-MM-dd'T'HH:mm:ss")
    return {
        "Daily_Quality_Metrics": sheet_daily_quality_metrics(sales).orderBy("date_value"),
        "Customer_Data_Quality": sheet_customer_data_quality(customers).orderBy("date_value"),
        "Return_Rate_Analysis": sheet_return_rate_analysis(returns).orderBy("date_value"),
        "Product_Quality": sheet_product_quality(products),
        "Overall_Summary": summary.select(
            F.concat(stamp, F.lit("+08:00")).alias("report_timestamp"), "*"
        ),
        "Anomaly_Details": monitoring.anomaly_details(sales, returns).orderBy(
            "Date", "Issue_Type"
        ),
        "Monthly_Trends": monitoring.monthly_trends(sales).orderBy("year", "month"),
    }


def run_summary(
    cleaning: DataFrame,
    summary: DataFrame,
    gate: DataFrame,
    best_country: DataFrame,
    scored: DataFrame,
    dimension_tables: int = 4,
    seconds: dict[str, float] | None = None,
) -> DataFrame:
    """One row for the end of a run, from one-row results and the first top country.

    ``seconds`` are the times of the run's stages; their sum is its ``processing_time``.
    """
    extraction = cleaning.select(
        F.col("final_rows").alias("rows_processed"),
        F.col("rows_dropped").alias("rows_rejected"),
        "drop_rate",
    )
    warehouse = summary.select(
        F.col("total_transactions").alias("fact_rows"),
        F.lit(dimension_tables).alias("dimension_tables"),
        "date_range_start",
        "date_range_end",
        "total_revenue",
        "return_rate",
        "unique_customers",
        "unique_products",
        "unique_countries",
    )
    summary_row = side_by_side(
        extraction,
        warehouse,
        gate.select("overall_status"),
        scored.select(F.col("quality_score").alias("data_quality_score")),
        best_country.select(
            F.col("country_name").alias("best_country"),
            F.col("revenue").alias("best_country_revenue"),
        ),
    )
    if seconds is None:
        return summary_row
    times = {"processing_time": sum(seconds.values())} | {f"{k}_seconds": v for k, v in seconds.items()}
    return summary_row.withColumns({name: F.lit(round(float(v), 3)) for name, v in times.items()})
