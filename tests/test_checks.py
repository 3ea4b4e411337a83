from datetime import date, datetime, timedelta

import frames
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import script_checks
from tallyhouse.plans import checks
from tallyhouse.session import materialise

AS_OF = datetime(2010, 3, 3, 9, 0)


@pytest.fixture
def catalogue(spark):
    return {check.name: check for check in checks.default_checks(AS_OF)}


def raw(spark, n=100, no_customer=0, copies=0, zero_price=0, big=0, age_hours=1):
    """``n`` lines with the given number of each defect."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i < copies, F.lit("0")).otherwise((i + 1).cast("string")).alias("invoice"),
        F.lit("A").alias("stock_code"),
        F.lit("text").alias("description"),
        F.when(i >= n - big, 1001).otherwise(1000).cast("int").alias("quantity"),
        F.lit(frames.DAY).cast("timestamp_ntz").alias("invoice_date"),
        F.when(i < zero_price, 0).otherwise(1).cast("decimal(10,2)").alias("price"),
        F.when(i >= no_customer, 1).cast("int").alias("customer_id"),
        F.lit("UK").alias("country"),
        F.lit(AS_OF - timedelta(hours=age_hours)).cast("timestamp_ntz").alias("created_at"),
    )


@pytest.fixture
def tables(spark):
    def build(rows=None, facts=None, **defects):
        facts = facts if facts is not None else [("1", 1, 1, 1, 1, 1, 1.0, 1.0, False)] * 95
        return {
            "raw": rows if rows is not None else raw(spark, **defects),
            "fact": frames.fact(spark, facts),
            "dim_product": spark.createDataFrame([(1, "A")], "product_key long, stock_code string"),
            "dim_customer": spark.createDataFrame([(1, 1)], "customer_key long, customer_id int"),
            "dim_time": spark.createDataFrame(
                [(1, date(2010, 3, 1))], "time_key long, date_value date"
            ),
        }

    return build


@pytest.mark.parametrize(
    ("name", "defects", "passed"),
    [
        ("null_critical_fields", {"no_customer": 15}, True),  # 15 / 300 is the limit itself
        ("null_critical_fields", {"no_customer": 16}, False),
        ("null_critical_fields", {"n": 0}, False),
        ("duplicate_records", {"copies": 2}, True),  # one copy in a hundred
        ("duplicate_records", {"copies": 3}, False),
        ("duplicate_records", {"n": 0}, True),
        ("data_range_validation", {"zero_price": 6, "big": 4}, True),
        ("data_range_validation", {"zero_price": 6, "big": 5}, False),
        ("data_range_validation", {"n": 0}, False),
        ("data_freshness", {"age_hours": 48}, True),
        ("data_freshness", {"age_hours": 49}, False),
        ("data_freshness", {"n": 0}, False),
        ("row_count_validation", {}, True),
        ("row_count_validation", {"n": 101}, False),
        ("row_count_validation", {"n": 0}, False),
    ],
)
def test_raw_thresholds(catalogue, tables, name, defects, passed):
    row = frames.one(checks.run_check(catalogue[name], tables(**defects)))
    assert row["passed"] is passed


GOOD = ("1", 1, 1, 1, 1, 1, 1.0, 1.0, False)


@pytest.mark.parametrize(
    ("name", "extra", "passed"),
    [
        ("referential_integrity", ("2", 1, 1, 1, None, 1, 1.0, 1.0, False), True),  # country is not asked
        ("referential_integrity", ("2", 7, 1, 1, 1, 1, 1.0, 1.0, False), False),
        ("referential_integrity", ("2", 1, None, 1, 1, 1, 1.0, 1.0, False), False),
        ("business_logic", ("2", 1, 1, 1, 1, 1, 1.0, 1.01, False), True),
        ("business_logic", ("2", 1, 1, 1, 1, 1, 1.0, 1.02, False), False),
        ("business_logic", ("2", 1, 1, 1, 1, -1, 1.0, -1.0, False), False),
        ("business_logic", ("2", 1, 1, 1, 1, -1, 1.0, -1.0, True), True),
    ],
)
def test_fact_checks(catalogue, tables, name, extra, passed):
    row = frames.one(checks.run_check(catalogue[name], tables(facts=[GOOD, extra])))
    assert row["passed"] is passed


@pytest.mark.parametrize(
    ("defects", "status", "score"),
    [
        ({}, "PASS", 100.0),
        ({"age_hours": 100}, "WARNING", 85.7),
        ({"no_customer": 50, "age_hours": 100}, "CRITICAL_FAILURE", 71.4),
    ],
)
def test_overall_status_and_score(spark, tables, defects, status, score):
    report = checks.checks_report(spark, tables(**defects), checks.default_checks(AS_OF))
    row = frames.one(checks.quality_score(checks.checks_summary(report)))
    assert (row["overall_status"], row["quality_score"]) == (status, score)
    failed = checks.failed_checks(report)
    assert failed.count() == row["failed_checks"] == 7 - row["passed_checks"]


def test_report_carries_measures(spark, tables):
    report = checks.checks_report(spark, tables(no_customer=4), checks.default_checks(AS_OF))
    results = {r["check_name"]: r["results"] for r in report.collect()}
    assert results["null_critical_fields"]["null_customer_id"] == "4"
    assert results["row_count_validation"]["fact_count"] == "95"


def test_a_check_that_cannot_be_planned_fails_alone(spark, tables):
    broken = tables()
    broken["raw"] = broken["raw"].drop("price")
    del broken["dim_product"]
    report = checks.checks_report(spark, broken, checks.default_checks(AS_OF))
    rows = {r["check_name"]: r for r in report.collect()}
    assert len(rows) == 7
    failed = {name for name, r in rows.items() if not r["passed"]}
    assert failed == {"data_range_validation", "referential_integrity", "row_count_validation"}
    assert "price" in rows["data_range_validation"]["error"]
    assert rows["null_critical_fields"]["error"] is None


def test_a_check_that_breaks_while_running_fails_alone(spark, catalogue, tables):
    bad = checks.Check(
        "raw_data_checks",
        "breaks",
        "Raises while it runs",
        0,
        True,
        lambda m, limit: m("n") <= limit,
        "raw",
        {"n": F.sum(F.raise_error(F.lit("no such luck")).cast("int"))},
    )
    found = [catalogue["duplicate_records"], bad]
    rows = {
        r["check_name"]: r
        for r in checks.checks_report_isolated(spark, tables(), found).collect()
    }
    assert rows["duplicate_records"]["passed"]
    assert not rows["breaks"]["passed"] and "no such luck" in rows["breaks"]["error"]


def test_sound_tables_take_one_plan_and_a_broken_check_costs_itself(spark, tables, catalogue, monkeypatch):
    plans, real = [], checks.checks_report

    def counted(spark, tables, found):
        plans.append(len(found))
        return real(spark, tables, found)

    monkeypatch.setattr(checks, "checks_report", counted)
    names = lambda report: [(r["check_name"], r["passed"]) for r in report.collect()]
    sound = names(checks.checks_report_isolated(spark, tables(), list(catalogue.values())))
    assert plans == [7] and len(sound) == 7
    bad = checks.Check(
        "raw_data_checks", "breaks", "breaks", 0.0, False, lambda m, limit: m("x") > 0, "raw",
        {"x": F.max(F.raise_error(F.lit("no such luck")).cast("int"))},
    )
    plans.clear()
    found = checks.checks_report_isolated(spark, tables(), [*catalogue.values(), bad])
    assert names(found) == [*sound, ("breaks", False)] and len(plans) <= 7
    assert "no such luck" in found.where("check_name = 'breaks'").first()["error"]


def test_unknown_check_fails(spark, tables):
    seven = checks.default_checks(AS_OF)
    row = frames.one(checks.run_named(spark, "no_such_check", tables(), seven))
    assert not row["passed"] and "no_such_check" in row["error"]
    assert frames.one(checks.run_named(spark, "data_freshness", tables(), seven))["passed"]


def test_script_returns_all_ten(spark, tables):
    t = tables()
    found = script_checks.run_script(t["raw"], t["fact"], t, AS_OF)
    assert len(found) == 10
    assert frames.one(found["Data Freshness"])["hours_since_last_load"] == 1.0
    assert frames.one(found["Duplicate Check"])["duplicates"] == 0


def test_script_reads_its_rows_few_times(spark, tables):
    """Fused profiles equal the single ones, and only the distinct count goes back to the rows."""
    t = tables()
    raw = materialise(t["raw"], "test-raw")
    files = set(raw.inputFiles())
    found = script_checks.run_script(raw, t["fact"], t, AS_OF)
    assert {n for n, f in found.items() if files & set(f.inputFiles())} == {"Duplicate Check"}
    single = {
        "Critical Null Check": script_checks.critical_nulls(raw),
        "Range Validation": script_checks.ranges(raw),
        "Return Analysis": script_checks.returns(raw),
        "Date Range Check": script_checks.date_range(raw),
        "Country Validation": script_checks.countries(raw),
        "Top Countries": script_checks.top_countries_share(raw),
        "Data Freshness": script_checks.freshness(raw, AS_OF),
    }
    for name, alone in single.items():
        assert found[name].dtypes == alone.dtypes and found[name].collect() == alone.collect()


def test_script_on_edge_rows(spark):
    rows = frames.staged(
        spark,
        [
            ("C1", "A" * 21, "x", -1, datetime(2008, 1, 1), 0, None, ""),
            ("c2", "A", "x", 1001, datetime(2012, 1, 1), None, 1, None),
            ("3", "A", "x", 1, datetime(2012, 1, 2), 1, 1, "UK"),
        ],
    )
    assert frames.one(script_checks.ranges(rows)) == {
        "total_rows": 3,
        "invalid_price": 1,
        "suspicious_quantity": 1,
        "negative_quantity": 1,
        "long_stock_code": 1,
    }
    assert frames.one(script_checks.returns(rows))["return_percentage"] == 33.33
    assert frames.one(script_checks.date_range(rows))["out_of_range_dates"] == 2
    assert frames.one(script_checks.countries(rows)) == {
        "unique_countries": 2,
        "null_empty_country": 2,
        "total_records": 3,
        "null_empty_percentage": 66.67,
    }
    assert frames.one(script_checks.critical_nulls(rows))["null_customer_pct"] == 33.33


def test_exact_amount_check_has_no_tolerance(spark):
    fact = frames.fact(spark, [("1", 1, 1, 1, 1, 1, 1.0, 1.01, False)])
    assert frames.one(script_checks.business_logic(fact))["calculation_errors"] == 1


def test_shares_are_of_all_rows_before_the_cut(spark):
    rows = frames.staged(
        spark,
        [(str(i), "A", "x", 1, frames.DAY, 1, 1, f"C{i % 20:02d}") for i in range(100)],
    )
    top = script_checks.top_countries_share(rows, 3).collect()
    assert [(r["country"], r["percentage"]) for r in top] == [
        ("C00", 5.0),
        ("C01", 5.0),
        ("C02", 5.0),
    ]
    everything = script_checks.top_countries_share(rows, 20)
    assert everything.agg(F.sum("percentage")).first()[0] == 100.0
