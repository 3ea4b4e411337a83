"""Small hand-written frames."""

from datetime import date, datetime
from decimal import Decimal

from tallyhouse.schemas import LANDING, STAGING
from tallyhouse.sources.landing import canonical_columns

DAY = datetime(2010, 3, 1, 9, 0)


def landed(spark, rows):
    """Rows of (invoice, code, text, quantity, when, price, customer, country)."""
    fixed = [
        (*r[:5], None if r[5] is None else Decimal(str(r[5])), *r[6:]) for r in rows
    ]
    return spark.createDataFrame(fixed, LANDING)


def raw(spark, rows):
    return canonical_columns(landed(spark, rows))


def staged(spark, rows):
    fixed = [
        (*r[:5], None if r[5] is None else Decimal(str(r[5])), *r[6:]) for r in rows
    ]
    return spark.createDataFrame(fixed, STAGING)


def fact(spark, rows):
    """Rows of (invoice, product, customer, time, country, quantity, price, amount, return)."""
    fixed = [(*r[:6], Decimal(str(r[6])), Decimal(str(r[7])), r[8]) for r in rows]
    return spark.createDataFrame(
        fixed,
        "invoice_no string, product_key long, customer_key long, time_key long,"
        " country_key long, quantity int, unit_price decimal(10,2),"
        " total_amount decimal(15,2), is_return boolean",
    )


def daily(spark, sales, rows_per_day=10, returns=None):
    """Daily profile with the given sales per day."""
    returns = returns or [0] * len(sales)
    return spark.createDataFrame(
        [
            (
                date(2010, 1 + i // 28, 1 + i % 28),
                2010,
                1 + i // 28,
                "Monday",
                False,
                rows_per_day,
                rows_per_day,
                3,
                returns[i],
                Decimal(str(amount)),
                Decimal("0"),
                Decimal("0"),
            )
            for i, amount in enumerate(sales)
        ],
        "date_value date, year int, month int, day_name string, is_weekend boolean,"
        " total_transactions long, transactions_with_customer long, unique_customers long,"
        " return_transactions long, daily_sales decimal(25,2), daily_returns decimal(25,2),"
        " return_amount decimal(25,2)",
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)
