"""Retail-shaped landing frame derived from the order tables.

Gives the engine realistic input: one row per order line, under the source's
own headers, with gaps, returns, bad prices and copies placed by arithmetic on
the keys. ``FIXTURES.md`` defines it. No randomness, so SQL can rebuild it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.schemas import PRICE

# Line position in the source: decides which copy of a duplicate comes first.
POSITION = ("src_order", "src_line", "src_part", "src_supp")
POSITION_SCHEMA = T.StructType(
    [
        T.StructField("src_order", T.LongType()),
        T.StructField("src_line", T.IntegerType()),
        T.StructField("src_part", T.LongType()),
        T.StructField("src_supp", T.LongType()),
    ]
)


def retail_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing frame over the whole tables.

    Customers are joined to orders before the lines come in, so the largest
    table takes part in two joins only; which sides get broadcast is left to
    Spark's own size check.
    """
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name", "p_retailprice"
    )
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )

    placed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    # Lines meet their orders while they are narrow: names of parts come in behind that shuffle.
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )

    order, part_no, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    sent_back = F.col("l_returnflag") == "R"
    invoice = F.when(
        sent_back & (order % 7 == 0), F.concat(F.lit("C"), order.cast("string"))
    ).otherwise(order.cast("string"))
    # Longer numbers keep all their digits.
    digits = part_no.cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), F.lit("0"))
    stock_code = (
        F.when(part_no % 211 == 0, F.lit(None).cast("string"))
        .when(part_no % 97 == 0, F.concat(F.lit("P"), (part_no % 10).cast("string")))
        .otherwise(F.concat(F.lit("P"), padded))
    )
    description = (
        F.when(part_no % 53 == 0, F.lit(None).cast("string"))
        .when(part_no % 59 == 0, F.lit(""))
        .when((order + line) % 2 == 0, F.upper("p_name"))
        .otherwise(F.col("p_name"))
    )
    bulk = F.when((line == 7) & (order % 23 == 0), 100).otherwise(1)
    sign = F.when(sent_back & (order % 7 == 1), -1).otherwise(1)
    hours = F.make_dt_interval(F.lit(0), line % 3)
    return joined.select(
        invoice.alias("Invoice"),
        stock_code.alias("StockCode"),
        description.alias("Description"),
        (F.col("l_quantity").cast("int") * bulk * sign).alias("Quantity"),
        F.when(order % 401 != 0, F.col("o_orderdate") + hours).alias("InvoiceDate"),
        F.when((part_no + order) % 89 == 0, F.lit(0).cast(PRICE))
        .otherwise(F.col("p_retailprice").cast(PRICE))
        .alias("Price"),
        F.when(order % 19 != 0, F.col("o_custkey").cast("int")).alias("Customer ID"),
        F.when(F.col("o_custkey") % 499 != 0, F.col("n_name")).alias("Country"),
        order.alias("src_order"),
        line.alias("src_line"),
        part_no.alias("src_part"),
        F.col("l_suppkey").alias("src_supp"),
    )
