from datetime import date, datetime
from decimal import Decimal

import frames
import numpy as np
from pyspark.sql import functions as F

from tallyhouse.plans import monitoring, report


def by_day(df):
    return [r.asDict() for r in df.orderBy("date_value").collect()]


def test_one_day(spark):
    daily = frames.daily(spark, [100], returns=[3])
    sales = by_day(monitoring.daily_sales_range(daily))[0]
    assert sales["std_sales"] is None and sales["z_score"] is None
    assert (sales["is_outlier"], sales["outlier_type"], sales["quality_score"]) == (
        False,
        "Normal",
        100,
    )
    rates = by_day(monitoring.return_rate_analysis(daily))[0]
    assert rates["return_rate"] == 30.0
    assert (rates["is_return_anomaly"], rates["return_status"]) == (False, "Normal")


def test_flat_days(spark):
    daily = frames.daily(spark, [33.33] * 5, returns=[1] * 5)
    for row in by_day(monitoring.daily_sales_range(daily)):
        assert row["z_score"] is None and not row["is_outlier"]
    for row in by_day(monitoring.return_rate_analysis(daily)):
        assert row["return_rate_z_score"] is None and row["return_status"] == "Normal"


def test_no_days(spark):
    daily = frames.daily(spark, [1]).where("false")
    assert monitoring.daily_sales_range(daily).count() == 0
    fences = frames.one(monitoring.iqr_fences(daily))
    assert set(fences.values()) == {None}
    assert monitoring.anomaly_details(
        monitoring.daily_sales_range(daily), monitoring.return_rate_analysis(daily)
    ).columns == ["Date", "Issue_Type", "Severity", "Value", "Description"]


def test_outlier_days(spark):
    values = [100 + i for i in range(18)] + [1234567.5, 0]
    daily = frames.daily(spark, values, returns=[1] * 19 + [9])
    rows = by_day(monitoring.daily_sales_range(daily))
    q25, q75 = np.quantile(values, [0.25, 0.75])
    for row, value in zip(rows, values):
        assert row["is_outlier"] == (
            value < q25 - 1.5 * (q75 - q25) or value > q75 + 1.5 * (q75 - q25)
        )
        z = (value - np.mean(values)) / np.std(values, ddof=1)
        assert abs(row["z_score"] - z) < 1e-9
    assert [r["outlier_type"] for r in rows[-2:]] == ["High", "Low"]
    assert rows[-1]["quality_score"] == 85
    found = monitoring.anomaly_details(
        monitoring.daily_sales_range(daily), monitoring.return_rate_analysis(daily)
    ).collect()
    texts = {(r["Issue_Type"], r["Severity"]): r["Description"] for r in found}
    assert texts == {
        ("Sales Outlier", "High"): "High sales day: $1,234,567.50",
        ("Sales Outlier", "Medium"): "Low sales day: $0.00",
        ("Return Rate Anomaly", "Medium"): "Unusual return rate: 90.0%",
    }


def test_fences_are_open(spark):
    """A value on the fence is normal."""
    daily = frames.daily(spark, [0, 10, 10, 20, 20, 35])
    fences = frames.one(monitoring.iqr_fences(daily))
    assert fences["q25"] == 10 and fences["q75"] == 20 and fences["upper_bound"] == 35
    assert not any(r["is_outlier"] for r in by_day(monitoring.daily_sales_range(daily)))


def test_low_return_status(spark):
    rows = by_day(
        monitoring.return_rate_analysis(frames.daily(spark, [1] * 6, returns=[5, 5, 5, 5, 5, 0]))
    )
    assert [r["return_status"] for r in rows] == ["Normal"] * 5 + ["Low"]


def test_missing_customer_bands(spark):
    days = spark.createDataFrame(
        [(date(2010, 1, i + 1), 2010, 1, 100, 100 - gap) for i, gap in enumerate((0, 5, 6, 10, 11, 60))],
        "date_value date, year int, month int, total_transactions long,"
        " transactions_with_customer long",
    )
    rows = by_day(monitoring.missing_customer_rate(days))
    assert [r["quality_status"] for r in rows] == [
        "Good",
        "Good",
        "Warning",
        "Warning",
        "Critical",
        "Critical",
    ]
    assert [r["quality_score"] for r in rows] == [100, 100, 90, 50, 50, 50]


PRODUCTS = [(1, "AB", None), (2, "ABC", ""), (3, "ABC2", "ok"), (4, "X", "ok")]
FACTS = [
    ("1", 1, 1, 1, 1, 2, 5.0, 10.0, False),
    ("C2", 1, 1, 1, 1, -1, 5.0, -5.0, True),
    ("3", 3, 2, 2, 1, 1, 5.0, 5.0, False),
]


def test_product_quality(spark):
    dim = spark.createDataFrame(PRODUCTS, "product_key long, stock_code string, description string")
    products = monitoring.product_quality(frames.fact(spark, FACTS), dim)
    rows = {r["stock_code"]: r for r in products.collect()}
    assert {k: r["quality_score"] for k, r in rows.items()} == {
        "AB": 50,
        "ABC": 75,
        "ABC2": 100,
        "X": 75,
    }
    assert rows["AB"]["total_revenue"] == Decimal("5.00") and rows["AB"]["transaction_count"] == 2
    assert rows["X"]["total_revenue"] is None and rows["X"]["transaction_count"] == 0
    sheet = report.sheet_product_quality(products).collect()
    assert [r["stock_code"] for r in sheet] == ["AB", "ABC2", "ABC", "X"]


def times(spark):
    return spark.createDataFrame(
        [
            (1, date(2010, 1, 1), 2010, 1, "Friday", False),
            (2, date(2010, 2, 1), 2010, 2, "Monday", False),
            (3, date(2010, 2, 2), 2010, 2, "Tuesday", False),
        ],
        "time_key long, date_value date, year int, month int, day_name string, is_weekend boolean",
    )


def test_profile_summary_and_trend(spark):
    fact = frames.fact(spark, FACTS)
    daily = monitoring.daily_profile(fact, times(spark))
    first, second = by_day(daily)  # the third day has no facts
    assert first["daily_sales"] == Decimal("10.00") and first["daily_returns"] == Decimal("-5.00")
    assert first["return_amount"] == Decimal("5.00") and first["unique_customers"] == 1
    assert second["daily_returns"] == 0
    summary = frames.one(monitoring.overall_summary(fact, times(spark)))
    assert summary["total_days"] == 2 and summary["max_date"] == date(2010, 2, 1)
    assert (summary["total_sales"], summary["total_returns"]) == (15.0, 5.0)
    assert summary["overall_return_rate"] == 33.33 and summary["unique_products"] == 2
    months = monitoring.monthly_trends(monitoring.daily_sales_range(daily)).orderBy("month")
    assert [tuple(r)[2:] for r in months.collect()] == [
        (Decimal("10.00"), Decimal("10.00"), 1, Decimal("100.00"), 2),
        (Decimal("5.00"), Decimal("5.00"), 1, Decimal("100.00"), 1),
    ]


def test_summary_of_nothing(spark):
    summary = frames.one(monitoring.overall_summary(frames.fact(spark, []), times(spark)))
    assert summary.pop("min_date") is None and summary.pop("max_date") is None
    assert set(summary.values()) == {0}


def test_report_has_seven_sheets(spark):
    fact = frames.fact(spark, FACTS)
    dim = spark.createDataFrame(PRODUCTS, "product_key long, stock_code string, description string")
    daily = monitoring.daily_profile(fact, times(spark))
    sheets = report.report_sheets(daily, fact, times(spark), dim, datetime(2024, 1, 1, 20, 0, 1))
    assert list(sheets) == [
        "Daily_Quality_Metrics",
        "Customer_Data_Quality",
        "Return_Rate_Analysis",
        "Product_Quality",
        "Overall_Summary",
        "Anomaly_Details",
        "Monthly_Trends",
    ]
    assert sheets["Overall_Summary"].first()["report_timestamp"] == "2024-01-02T04:00:01+08:00"
    counters = monitoring.monitoring_counters(
        monitoring.daily_sales_range(daily),
        monitoring.missing_customer_rate(daily),
        monitoring.return_rate_analysis(daily),
        monitoring.product_quality(fact, dim),
    )
    assert frames.one(counters.select(F.struct("*").alias("c")))["c"] == {
        "outlier_days": 0,
        "critical_days": 0,
        "return_anomaly_days": 0,
        "products_with_issues": 3,
    }
