from datetime import datetime, timedelta
from decimal import Decimal

import frames
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import cleaning
from tallyhouse.operators.rules import apply_rules, rule_violations
from tallyhouse.sources.landing import require_columns, stage_projection

DAY = frames.DAY
EDGE = [
    ("1", "A", "x", 5, DAY, 2, 10, "UK"),
    ("1", "A", "y", 7, DAY, 2, 10, "UK"),  # same key, later position by text
    ("1", "A", "x", 5, DAY, 2, 10, "UK"),  # exact copy
    ("C2", "A", "x", 1, DAY, 2, 10, "UK"),
    ("c3", "A", "x", 1, DAY, 0, 10, "UK"),
    ("4", "B", None, -1, DAY, -1, 11, None),
    ("5", "B", "", 1000, DAY, None, 11, "FR"),
    ("6", "B", "z", 1001, DAY, 1, 11, "FR"),
    (None, "B", "z", 0, DAY, 1, 11, "FR"),
    ("7", None, "z", 1, DAY, 1, 11, "FR"),
    ("8", "B", "z", 1, None, 1, 11, "FR"),
    ("9", "B", "z", 1, DAY, 1, None, "FR"),
]


def test_required_columns_are_named(spark):
    df = frames.raw(spark, EDGE).drop("StockCode", "CustomerID")
    with pytest.raises(ValueError, match=r"\['StockCode', 'CustomerID'\]"):
        require_columns(df)


def test_clean_edge_rows(spark):
    rows = {r["InvoiceNo"]: r for r in cleaning.clean(frames.raw(spark, EDGE)).collect()}
    assert set(rows) == {"1", "C2", "c3", "4", "5", "6", None}
    assert rows["1"]["Description"] == "x" and rows["1"]["Quantity"] == 5
    assert [rows[k]["is_return"] for k in ("1", "C2", "c3", "4", None)] == [
        False,
        True,
        False,
        True,
        False,
    ]
    assert [rows[k]["price_flag"] for k in ("1", "c3", "4", "5")] == [False, True, True, True]
    assert [rows[k]["quantity_flag"] for k in ("5", "6")] == [False, True]
    assert rows["6"]["TotalAmount"] == Decimal("1001.00")
    assert rows["5"]["TotalAmount"] is None


def test_processed_at_is_the_given_time(spark):
    at = datetime(2020, 1, 2, 3, 4, 5)
    assert cleaning.clean(frames.raw(spark, EDGE), processed_at=at).first()["processed_at"] == at


def test_position_decides_the_survivor(spark):
    df = frames.raw(spark, EDGE[:3]).coalesce(1).withColumn("pos", F.monotonically_increasing_id())
    last_first = df.withColumn("pos", -F.col("pos"))
    assert frames.one(cleaning.dedup_source(last_first, ["pos"]))["pos"] == -2
    assert frames.one(cleaning.dedup_source(df, ["pos"]))["pos"] == 0


def test_cleaning_stats(spark):
    assert frames.one(cleaning.cleaning_stats(frames.raw(spark, EDGE))) == {
        "null_drops": 3,
        "invalid_price_count": 3,
        "high_quantity_count": 1,
        "return_count": 2,
        "duplicates_removed": 2,
        "initial_rows": 12,
        "final_rows": 7,
        "rows_dropped": 5,
        "drop_rate": 41.67,
    }


def test_cleaning_stats_of_nothing(spark):
    stats = frames.one(cleaning.cleaning_stats(frames.raw(spark, [])))
    assert stats.pop("drop_rate") is None
    assert set(stats.values()) == {0}


def test_stage_projection_rounds_prices(spark):
    df = frames.raw(spark, EDGE[:1]).withColumn("UnitPrice", F.lit(0.001))
    row = frames.one(stage_projection(df.withColumn("extra", F.lit(1))))
    assert row["price"] == Decimal("0.00") and "extra" not in row and len(row) == 8


KEYS = st.tuples(st.sampled_from("12"), st.sampled_from("AB"), st.integers(0, 2))
LINES = st.lists(
    st.tuples(KEYS, st.sampled_from([None, "p", "q"]), st.integers(-3, 3), st.booleans()),
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(LINES)
def test_dedup_properties(spark, lines):
    rows = [
        (inv, code, text, qty, DAY + timedelta(hours=hour), 1, 1 if known else None, "UK")
        for (inv, code, hour), text, qty, known in lines
    ]
    df = frames.raw(spark, rows)
    once = cleaning.dedup_source(cleaning.drop_critical_nulls(df))
    result = sorted(map(str, once.collect()))
    assert result == sorted(map(str, cleaning.dedup_source(once).collect()))
    assert result == sorted(
        map(
            str,
            cleaning.dedup_source(cleaning.drop_critical_nulls(df.repartition(5))).collect(),
        )
    )
    stats = frames.one(cleaning.cleaning_stats(df))
    assert stats["initial_rows"] == len(rows)
    assert stats["final_rows"] == len(result)
    assert len(rows) == stats["final_rows"] + stats["null_drops"] + stats["duplicates_removed"]


def test_rules_drop_and_flag(spark):
    df = frames.landed(spark, EDGE)
    kept = apply_rules(df)
    assert kept.count() == 10
    flags = {r["Invoice"]: (r["price_flag"], r["quantity_flag"]) for r in kept.collect()}
    assert flags["5"] == (True, True)  # a missing price fails, and 1000 is not below 1000
    assert flags["1"] == (False, False)
    counts = {r["field"]: r["violations"] for r in rule_violations(df).collect()}
    assert counts == {"Customer ID": 1, "Price": 3, "Quantity": 2, "StockCode": 1}


def test_rules_with_only_flags_keep_all_rows(spark):
    df = frames.landed(spark, EDGE)
    only = [
        {"field": "Quantity", "type": "greater_than", "value": 0, "action": "flag"},
        {"field": "Quantity", "type": "less_than", "value": 10, "action": "flag"},
    ]
    result = apply_rules(df, only)
    assert result.count() == len(EDGE)
    assert result.where("quantity_flag").count() == 4


@pytest.mark.parametrize(
    "spec",
    [
        {"field": "Price", "type": "between", "action": "flag"},
        {"field": "Price", "type": "not_null", "action": "explode"},
    ],
)
def test_unknown_rules_are_refused(spark, spec):
    with pytest.raises(ValueError, match="Unknown rule"):
        apply_rules(frames.landed(spark, EDGE), [spec])
