"""Table schemas and the constraints that go with them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(15, 2)

# Landed sheet, under the headers the source uses.
LANDING = _schema(
    ("Invoice", T.StringType()),
    ("StockCode", T.StringType()),
    ("Description", T.StringType()),
    ("Quantity", T.IntegerType()),
    ("InvoiceDate", T.TimestampNTZType()),
    ("Price", PRICE),
    ("Customer ID", T.IntegerType()),
    ("Country", T.StringType()),
)

STAGING = _schema(
    ("invoice", T.StringType()),
    ("stock_code", T.StringType()),
    ("description", T.StringType()),
    ("quantity", T.IntegerType()),
    ("invoice_date", T.TimestampNTZType()),
    ("price", PRICE),
    ("customer_id", T.IntegerType()),
    ("country", T.StringType()),
)

# Header -> canonical name, and canonical name -> staging name.
CANONICAL_NAMES = {"Customer ID": "CustomerID", "Invoice": "InvoiceNo", "Price": "UnitPrice"}
STAGING_NAMES = {
    "InvoiceNo": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "price",
    "CustomerID": "customer_id",
    "Country": "country",
}
REQUIRED_COLUMNS = ("InvoiceNo", "StockCode", "InvoiceDate", "CustomerID")
CRITICAL_COLUMNS = ("CustomerID", "StockCode", "InvoiceDate")
SOURCE_KEYS = ("InvoiceNo", "StockCode", "InvoiceDate")


@dataclass(frozen=True)
class Contract:
    """What the warehouse promises about one table; Parquet itself enforces none of it."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)  # column -> dimension
    widths: dict[str, int] = field(default_factory=dict)  # column -> longest text


# Surrogate key column of each dimension.
DIMENSION_KEYS = {
    "dim_time": "time_key",
    "dim_country": "country_key",
    "dim_product": "product_key",
    "dim_customer": "customer_key",
}
NATURAL_KEYS = {
    "dim_time": "date_value",
    "dim_country": "country_name",
    "dim_product": "stock_code",
    "dim_customer": "customer_id",
}

CONTRACTS = {
    "raw_retail_data": Contract(widths={"invoice": 20, "stock_code": 20, "country": 50}),
    "dim_country": Contract(
        not_null=("country_name",), unique=("country_name",), widths={"country_name": 50}
    ),
    "dim_time": Contract(
        not_null=("date_value",), unique=("date_value",), widths={"month_name": 20, "day_name": 20}
    ),
    "dim_product": Contract(
        not_null=("stock_code",), unique=("stock_code",), widths={"stock_code": 20}
    ),
    "dim_customer": Contract(
        not_null=("customer_id",),
        unique=("customer_id",),
        references={"country_key": "dim_country"},
    ),
    "fact_sales": Contract(
        not_null=("invoice_no", "quantity", "unit_price", "total_amount"),
        unique=("invoice_no", "product_key", "time_key"),
        references={
            "product_key": "dim_product",
            "customer_key": "dim_customer",
            "time_key": "dim_time",
            "country_key": "dim_country",
        },
        widths={"invoice_no": 20},
    ),
}
