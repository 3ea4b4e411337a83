from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import frames
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators.dimensions import customer_rows, product_rows, time_rows
from tallyhouse.operators.fact import dedup_day
from tallyhouse.operators.keys import with_dense_key
from tallyhouse.plans.warehouse import build_star, build_stats

DAY = frames.DAY


def lines(*rows):
    """(invoice, code, text, quantity, hour offset, customer, country)."""
    return [
        (inv, code, text, qty, DAY + timedelta(hours=h), 2, who, where)
        for inv, code, text, qty, h, who, where in rows
    ]


MODES = lines(
    ("1", "A", "b", 1, 0, 1, "UK"),
    ("2", "A", "b", 1, 0, 1, "UK"),
    ("3", "A", "a", 1, 0, 1, "UK"),
    ("1", "B", "z", 1, 0, 1, "UK"),
    ("2", "B", "y", 1, 0, 1, "UK"),
    ("1", "C", None, 1, 0, 1, "UK"),
    ("2", "C", None, 1, 0, 1, "UK"),
    ("1", "D", None, 1, 0, 1, "UK"),
    ("2", "D", None, 1, 0, 1, "UK"),
    ("3", "D", "only", 1, 0, 1, "UK"),
)


def test_product_description_is_the_mode(spark):
    found = {r[0]: r[1] for r in product_rows(frames.staged(spark, MODES)).collect()}
    assert found == {"A": "b", "B": "y", "C": None, "D": "only"}


def test_time_rows(spark):
    sunday = frames.staged(
        spark, [("1", "A", "x", 1, DAY - timedelta(days=1), 1, 1, "UK"), *MODES]
    )
    rows = {r["date_value"]: r for r in time_rows(sunday).collect()}
    assert len(rows) == 2
    first, second = rows[date(2010, 2, 28)], rows[date(2010, 3, 1)]
    assert (first["day_of_week"], first["day_name"], first["is_weekend"]) == (7, "Sunday", True)
    assert (second["day_of_week"], second["day_name"], second["is_weekend"]) == (
        1,
        "Monday",
        False,
    )
    assert (second["year"], second["quarter"], second["month_name"]) == (2010, 1, "March")


def test_customer_country_comes_from_the_first_row(spark):
    rows = lines(
        ("2", "A", "x", 1, 5, 1, "FR"),
        ("1", "A", "x", 1, 0, 1, "UK"),
        ("3", "A", "x", 1, 0, 2, None),  # first row has no country
        ("4", "A", "x", 1, 1, 2, "UK"),
        ("5", "A", "x", 1, 0, 3, "XX"),  # unknown country
    )
    countries = spark.createDataFrame([(1, "FR"), (2, "UK")], "country_key long, country_name string")
    found = {r[0]: r[1] for r in customer_rows(frames.staged(spark, rows), countries).collect()}
    assert found == {1: 2, 2: None, 3: None}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.integers(-(10**6), 10**6), max_size=200))
def test_keys_are_dense_and_ordered(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n int").repartition(7)
    rows = with_dense_key(df, "n", "k").orderBy("n").collect()
    assert [(r["k"], r["n"]) for r in rows] == list(enumerate(sorted(values), 1))


def test_keys_are_dense_over_many_partitions(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_021).alias("n")).distinct()
    keyed = with_dense_key(df, "n", "k")
    rows = keyed.agg(F.min("k"), F.max("k"), F.count_distinct("k"), F.count("*")).first()
    assert tuple(rows) == (1, 50_000, 50_000, 50_000)
    bad = keyed.alias("a").join(keyed.alias("b"), F.col("b.k") == F.col("a.k") + 1)
    assert bad.where("b.n <= a.n").count() == 0


def test_day_dedup_keeps_the_earliest_line_and_does_not_add_up(spark):
    rows = lines(
        ("1", "A", "x", 4, 3, 1, "UK"),
        ("1", "A", "x", 9, 1, 1, "UK"),
        ("1", "A", "x", 5, 24, 1, "UK"),
        ("1", "B", "x", 6, 1, 1, "UK"),
    )
    kept = dedup_day(frames.staged(spark, rows)).collect()
    assert sorted((r["stock_code"], r["quantity"]) for r in kept) == [("A", 5), ("A", 9), ("B", 6)]


def test_star_of_edge_rows(spark):
    rows = lines(
        ("1", "A", "x", 4, 0, 1, "UK"),
        ("1", "A", "x", 9, 1, 1, "UK"),  # same day: lost
        ("C2", "A", "x", 1, 2, 2, None),  # no country: kept
        ("3", "B", None, -2, 24, 1, "UK"),
        ("4", None, "x", 1, 0, 1, "UK"),
        ("5", "B", "x", 1, 0, None, "UK"),
    )
    staging = frames.staged(spark, rows).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    star = build_star(staging)
    facts = {r["invoice_no"]: r for r in star.fact.collect()}
    assert set(facts) == {"1", "C2", "3"}
    assert facts["1"]["total_amount"] == Decimal("8.00") and not facts["1"]["is_return"]
    assert facts["C2"]["country_key"] is None and facts["C2"]["is_return"]
    assert facts["3"]["is_return"] and facts["3"]["total_amount"] == Decimal("-4.00")
    assert len({r["sale_id"] for r in facts.values()}) == 3
    assert frames.one(build_stats(staging, star)) == {
        "staging_rows": 4,
        "dim_time_rows": 2,
        "dim_country_rows": 1,
        "dim_product_rows": 2,
        "dim_customer_rows": 2,
        "fact_rows": 3,
    }


def test_star_of_nothing(spark):
    star = build_star(frames.staged(spark, []))
    assert all(df.count() == 0 for df in star.tables.values())


def test_hot_keys_give_whole_results(spark):
    """One customer, product and day hold most rows, with many copies of one key."""
    hot = spark.range(20_000).select(
        F.lit("1").alias("invoice"),
        F.lit("HOT").alias("stock_code"),
        F.concat(F.lit("t"), F.col("id") % 300).alias("description"),
        (F.col("id") % 50).cast("int").alias("quantity"),
        F.lit(DAY).cast("timestamp_ntz").alias("invoice_date"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        F.lit(1).alias("customer_id"),
        F.lit("UK").alias("country"),
    )
    cold = frames.staged(
        spark, lines(*[(f"x{i}", f"P{i % 40}", "d", 2, i, i % 30, "FR") for i in range(3000)])
    )
    star = build_star(hot.unionByName(cold))
    hot_fact = star.fact.where("invoice_no = '1'").collect()
    assert len(hot_fact) == 1 and hot_fact[0]["quantity"] == 0
    assert star.fact.count() == 3001
    uses = Counter(f"t{i % 300}" for i in range(20_000))
    best = min(uses, key=lambda t: (-uses[t], t))
    assert star.product.where("stock_code = 'HOT'").first()["description"] == best


def test_customers_ties_on_the_first_date(spark):
    """Several countries on the first date: the other columns decide; rows without a date come first."""
    later = DAY + timedelta(days=1)
    rows = [
        ("2", "A", "x", 1, DAY, 1, 1, "France"), ("1", "B", "x", 1, DAY, 1, 1, "Spain"), ("0", "B", "x", 1, later, 1, 1, "Italy"),
        ("1", "A", "x", 1, DAY, 1, 2, "Spain"), ("3", "A", "x", 1, DAY, 1, 2, "Spain"),
        ("5", "A", "x", 1, DAY, 1, 3, "Spain"), ("6", "A", "x", 1, None, 1, 3, "Italy"), ("7", "A", "x", 1, None, 1, 3, "France"),
        ("1", "A", "x", 1, DAY, 1, 4, None), ("2", "A", "x", 1, DAY, 1, 4, "Spain"), ("1", "A", "x", 1, later, 1, 5, "Italy"),
        ("1", "A", "x", 1, later, 1, None, "Italy"),
    ]
    countries = spark.createDataFrame([("France", 1), ("Italy", 2), ("Spain", 3)], "country_name string, country_key long")
    found = customer_rows(frames.staged(spark, rows), countries)
    assert {r.customer_id: r.country_key for r in found.collect()} == {1: 3, 2: 3, 3: 2, 4: None, 5: 2}


def test_only_tied_customers_aggregate_whole_rows(spark):
    """The aggregate that carries the other columns reads what a join with the ties leaves."""
    rows = [("1", "A", "x", 1, DAY, 1, n, "Spain") for n in range(3)]
    countries = spark.createDataFrame([("Spain", 3)], "country_name string, country_key long")
    text = customer_rows(frames.staged(spark, rows), countries)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in text[text.index("partial_min_by") :]
