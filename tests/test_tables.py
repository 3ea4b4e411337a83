import time
from datetime import datetime, timedelta
from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.functions.stamps import file_stamp, hours_between, ntz, utc8
from tallyhouse.operators.cleaning import cleaning_stats
from tallyhouse.sources import landing, tables
from tallyhouse.sources.versions import VersionedTable

DAY = frames.DAY
ROWS = [
    ("1", "A", 'said "hi", left', 5, DAY, 2.5, 10, "UK"),
    ("C2", "B", "", -1, DAY, 0, None, None),
    ("3", None, None, 7, None, None, 12, "FR"),
]
AS_OF = datetime(2010, 3, 2, 4, 5, 6)


def test_csv_and_parquet_landing_agree(spark, tmp_path):
    df = frames.landed(spark, ROWS)
    df.write.option("header", True).csv(str(tmp_path / "csv"))
    df.write.parquet(str(tmp_path / "parquet"))
    expected = sorted(map(str, df.collect()))
    for fmt in ("csv", "parquet"):
        read = landing.scan_raw(spark, str(tmp_path / fmt), fmt)
        assert sorted(map(str, read.collect())) == expected


def test_misfitting_csv_rows_fail(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(
        "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
        "1,A,x,many,2010-03-01 09:00:00,1.00,1,UK\n"
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landing.scan_raw(spark, str(tmp_path), "csv").collect()


def test_canonical_columns_ignore_absent_names(spark):
    df = frames.landed(spark, ROWS).drop("Price")
    assert landing.canonical_columns(df).columns == [
        "InvoiceNo",
        "StockCode",
        "Description",
        "Quantity",
        "InvoiceDate",
        "CustomerID",
        "Country",
    ]


def test_staging_is_replaced_and_counted(spark, tmp_path):
    path = str(tmp_path / "staging")
    raw = frames.raw(spark, ROWS)
    tables.load_staging(raw, path, AS_OF)
    loaded = tables.load_staging(raw.limit(2), path, AS_OF)
    assert loaded.rows_loaded == 2 and loaded.frame.count() == 2
    row = loaded.frame.where("invoice = '1'").first()
    assert row["created_at"] == AS_OF and row["price"] == Decimal("2.50")
    assert loaded.frame.select("id").distinct().count() == 2
    assert landing.staging_valid_rows(loaded.frame).count() == 1


def test_dimension_modes(spark, tmp_path):
    path = str(tmp_path / "dim")
    dim = spark.createDataFrame([(1, "UK")], "country_key long, country_name string")
    assert tables.load_dimension(dim, "dim_country", path).rows_loaded == 1
    more = spark.createDataFrame([(1, "FR"), (2, "UK")], "country_key long, country_name string")
    added = tables.load_dimension(more, "dim_country", path, "append")
    assert added.rows_loaded == 1
    assert sorted(map(tuple, added.frame.collect())) == [(1, "UK"), (2, "FR")]
    again = tables.load_dimension(dim, "dim_country", path, as_of=AS_OF)
    assert again.rows_loaded == 1 and again.frame.first()["created_at"] == AS_OF


def test_an_empty_fact_empties_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = frames.fact(spark, [("1", 1, 1, 1, 1, 1, 1.0, 1.0, False)]).select(
        "*", F.lit(2010).alias("year"), F.lit(3).alias("month")
    )
    assert tables.load_fact(fact, path).rows_loaded == 1
    added = tables.load_fact(fact, path, "append")
    assert added.rows_loaded == 1
    assert added.frame.count() == added.frame.select("sale_id").distinct().count() == 2
    assert tables.load_fact(fact.where("false"), path).frame.count() == 0
    other = fact.withColumn("month", F.lit(4))
    assert tables.load_fact(other, path).frame.select("month").collect() == [(4,)]


def test_retention(spark, tmp_path):
    ages = [0, 6, 7, 8, 30]
    staged = spark.createDataFrame(
        [(str(a), AS_OF - timedelta(days=a)) for a in ages] + [("none", None)],
        "invoice string, created_at timestamp_ntz",
    )
    assert frames.one(tables.retention_split(staged, AS_OF)) == {
        "rows_deleted": 2,
        "rows_kept": 4,
    }
    path = str(tmp_path / "staging")
    table = tables.stage_rows(staged, path)
    before = set(tables.accepted(table).inputFiles())
    kept = tables.apply_retention(spark, path, AS_OF)
    assert tables.accepted(table).count() == 4
    # Only the day that the limit falls into can be written again; here it loses no row.
    assert set(kept.frame.inputFiles()) < before
    assert {r["invoice"] for r in kept.frame.collect()} == {"0", "6", "7", "none"}
    assert kept.rows_deleted == 2
    untouched = tables.apply_retention(spark, path, AS_OF, 30)
    assert untouched.rows_deleted == 0 and untouched.frame.count() == 4


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_sheets_are_written_in_order(spark, tmp_path, fmt):
    sheets = {
        "One": spark.range(3).select("id", (F.col("id") / 2).alias("half")),
        "None": spark.range(3).where("false"),
    }
    written = tables.write_report(sheets, str(tmp_path), "20240101_0000", fmt)
    assert list(written) == ["One", "None"]
    assert (tmp_path / "report_ts=20240101_0000" / "One").is_dir()
    counts = {r["sheet"]: r["rows"] for r in tables.report_manifest(written).collect()}
    assert counts == {"One": 3, "None": 0}
    assert written["One"].agg(F.sum("half")).first()[0] == 1.5


def test_stamps(spark):
    moment = datetime(2024, 2, 28, 20, 30, 59, 999999)
    assert file_stamp(moment) == "20240229_0430"
    row = spark.range(1).select(
        utc8(ntz(moment)).alias("local"),
        hours_between(ntz(moment), ntz(moment + timedelta(minutes=90))).alias("hours"),
        hours_between(F.lit(None).cast("timestamp_ntz"), ntz(moment)).alias("unknown"),
    )
    assert tuple(row.first()) == (datetime(2024, 2, 29, 4, 30, 59), 1.5, None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_stamps_do_not_depend_on_the_session_zone(spark, zone):
    before = datetime(2024, 3, 10, 1, 30)  # an hour that New York skips follows
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(
            utc8(ntz(before + timedelta(hours=1))).alias("local"),
            hours_between(ntz(before), ntz(before + timedelta(hours=2))).alias("hours"),
        )
        assert tuple(row.first()) == (datetime(2024, 3, 10, 10, 30), 2.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    df = session.materialise(spark.range(5), "five")
    assert all(named in path for path in df.inputFiles())


def test_scratch_is_removed(spark, monkeypatch):
    class Other:
        """The same session as another application."""

        conf = spark.conf

        class sparkContext:
            applicationId, master = "some-other-app", spark.sparkContext.master
            _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
            getCheckpointDir = spark.sparkContext.getCheckpointDir

    assert not session.remove_scratch(Other)
    path, mine = session.new_folder(Other, "x"), session.materialise(spark.range(3), "mine")
    spark.range(3).write.parquet(path)
    assert session.remove_scratch(Other) and mine.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://somewhere:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_sizing_grows_with_the_input():
    partitions = [int(session.sizing(n)["spark.sql.shuffle.partitions"]) for n in (1, 1 << 30, 1 << 40, 100 << 40)]
    assert partitions == [8, 8, 8192, 51200]


def test_input_bytes_come_from_the_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name, n in (("x.csv", 10), ("a/y.csv", 7)):
        (tmp_path / name).write_bytes(b"1" * n)
    assert session.measured_bytes(spark, str(tmp_path)) == 17


HEADER = "Country,Customer ID,Price,InvoiceDate,Quantity,Description,StockCode,Invoice"
LINE = "UK,13085.0,1.25,2010-03-01 09:00:00,3,text,A1,7"


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text(f"{HEADER}\n{LINE}\n")
    row = landing.scan_raw(spark, str(tmp_path), "csv").first()
    assert (row["Invoice"], row["StockCode"], row["Description"], row["Customer ID"]) == ("7", "A1", "text", 13085)


def test_parts_of_ids_and_missing_columns_fail(spark, tmp_path):
    (tmp_path / "x.csv").write_text(f"{HEADER}\n{LINE.replace('13085.0', '13085.5')}\n")
    with pytest.raises(Exception, match="not a whole number"):
        landing.scan_raw(spark, str(tmp_path / "x.csv"), "csv").collect()
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / f"missing-{fmt}")
        frames.landed(spark, ROWS).drop("Customer ID").write.option("header", True).format(fmt).save(path)
        with pytest.raises(ValueError, match="Customer ID"):
            landing.scan_raw(spark, path, fmt)


def test_retention_rewrites_only_the_period_of_the_limit(spark, tmp_path):
    path, limit = str(tmp_path / "staging"), datetime(2010, 2, 10, 12)
    stamps = [datetime(2009, 12, 5), datetime(2010, 1, 31, 23), limit - timedelta(hours=1), limit, datetime(2010, 2, 28), datetime(2010, 3, 1)]
    staged = spark.createDataFrame([(str(i), s) for i, s in enumerate(stamps)], "invoice string, created_at timestamp_ntz")
    staged = staged.withColumn("invoice", F.when(F.col("invoice") == "5", F.repeat(F.lit("9"), F.lit(21))).otherwise(F.col("invoice")))
    for unit, same in (("month", 0), ("day", 1)):
        table = tables.stage_rows(staged, f"{path}-{unit}", unit)
        assert tables.quarantine(table).count() == 1
        old = tables.accepted(table)
        files = set(old.inputFiles())
        kept = tables.apply_retention(spark, f"{path}-{unit}", limit + timedelta(days=7))
        assert kept.rows_deleted == 3 and {r["invoice"] for r in kept.frame.collect()} == {"3", "4"}
        assert len(files & set(kept.frame.inputFiles())) == same
        assert old.count() == 5  # a reader that had begun


def test_a_broken_load_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "dim")
    dim = spark.createDataFrame([(1, "UK"), (2, "FR")], "country_key long, country_name string")
    tables.load_dimension(dim, "dim_country", path)
    broken = spark.range(100, numPartitions=4).select(
        F.col("id").alias("country_key"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("no such luck"))).otherwise(F.col("id").cast("string")).alias("country_name"),
    )
    with pytest.raises(Exception, match="no such luck"):
        tables.load_dimension(broken, "dim_country", path)
    assert tables.accepted(VersionedTable(spark, path)).count() == 2
    again = tables.load_dimension(dim.limit(1), "dim_country", path)
    assert again.frame.count() == 1


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "a int, part string")
    table.replace(rows((1, "x"), (2, "y"), (3, None)), ("part",))
    first, files = table.read(), set(table.read().inputFiles())
    assert table.replace_parts(rows((9, "y")), ("part",)).number == 2
    assert sorted(map(str, table.read().collect())) == sorted(map(str, rows((1, "x"), (9, "y"), (3, None)).collect()))
    assert len(files & set(table.read().inputFiles())) == 2
    assert first.count() == 3 and table.read(1).where("a = 2").count() == 1
    table.append(rows((4, "z")), ("part",))
    assert table.read().count() == 4
    assert table.expire(keep=1) == 1 and table.numbers() == [3] and table.read().count() == 4
    table.replace(rows().limit(0), ("part",))
    assert table.read().count() == 0 and table.read().columns == ["a", "part"]
    # A number that another writer took is not taken twice.
    stale = VersionedTable(spark, str(tmp_path / "t"))
    stale.numbers = lambda: [3]
    with pytest.raises(RuntimeError, match="another writer"):
        stale.commit(rows().schema, [])


def test_months_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "fact")
    day = lambda m, n: frames.fact(spark, [(str(n), n, 1, m, 1, 1, 1.0, 1.0, False)]).select(
        "*", F.lit(2010).alias("year"), F.lit(m).alias("month")
    )
    bad = day(2, 7).withColumn("invoice_no", F.lit(None).cast("string"))
    before = tables.load_fact(day(1, 1).unionByName(day(2, 2)).unionByName(bad), path)
    assert (before.rows_loaded, before.refused.count()) == (2, 1)
    assert before.refused.first()["reasons"] == ["invoice_no is null"]
    after = tables.load_fact(day(2, 5), path, "months")
    assert sorted((r.month, r.invoice_no) for r in after.frame.collect()) == [(1, "1"), (2, "5")]
    assert after.refused.count() == 0 and after.frame.select("sale_id").distinct().count() == 2
    assert len(set(before.frame.inputFiles()) & set(after.frame.inputFiles())) == 1


def test_observed_counts_equal_counted_ones(spark, tmp_path, monkeypatch):
    raw = frames.raw(spark, [*ROWS, *ROWS[:1], ("9" * 21, "A", "x", 5, DAY, 0, 3, "UK")]).repartition(3)
    loaded, stats = tables.load_observed(raw, str(tmp_path / "a"), AS_OF)
    expected = frames.one(cleaning_stats(raw, loaded.rows_loaded))
    assert frames.one(stats) == expected and expected["initial_rows"] == 5
    assert (loaded.rows_loaded, loaded.refused.count()) == (1, 1)
    # Metrics that a repeated stage has counted twice are not believed.
    real = tables.cleaning_counts
    monkeypatch.setattr(tables, "cleaning_counts", lambda: [(c * 2).alias(n) for c, n in zip(real(), expected_names)])
    _, again = tables.load_observed(raw, str(tmp_path / "b"), AS_OF)
    assert frames.one(again) == expected


expected_names = ("initial_rows", "kept_rows", "invalid_price_count", "high_quantity_count", "return_count")


def test_buckets_survive_retention_and_are_not_used_when_uneven(spark, tmp_path, monkeypatch):
    stamps = [datetime(2010, 2, 9), datetime(2010, 2, 10, 11), datetime(2010, 2, 10, 13), datetime(2010, 3, 1), None]
    rows = [(f"i{n % 7}", f"s{n % 5}", n, stamps[n % 5]) for n in range(200)]
    staged = spark.createDataFrame(rows, "invoice string, stock_code string, n int, created_at timestamp_ntz")
    staged = staged.withColumn("invoice", F.when(F.col("n") == 199, F.repeat(F.lit("9"), F.lit(21))).otherwise(F.col("invoice")))
    seen = lambda df: sorted(r.n for r in df.collect())
    grouped = lambda df: df.groupBy("invoice", "stock_code").count()._jdf.queryExecution().executedPlan().toString()
    path = str(tmp_path / "it's staged")
    table = tables.stage_rows(staged, path, buckets=4)
    assert table.version().buckets is not None
    old = tables.accepted(table)
    assert "Exchange" not in grouped(old)
    assert seen(old) == list(range(199)) and seen(tables.quarantine(table)) == [199]
    # The load day of the limit is written again, in buckets too; rows without a stamp stay.
    kept = tables.apply_retention(spark, path, datetime(2010, 2, 17, 12))
    left = [n for n in range(199) if n % 5 not in (0, 1)]
    assert seen(kept.frame) == left and kept.rows_deleted == 199 - len(left)
    assert "Exchange" not in grouped(kept.frame)
    assert seen(old) == list(range(199))
    # Another session knows the table by its list of folders alone.
    other = spark.newSession()
    again = tables.accepted(VersionedTable(other, path))
    assert seen(again) == left
    assert len(spark.catalog.listTables(pattern="tallyhouse_*")) > 0
    # Replaced twice, the first versions and their catalog entries go.
    gone = table._entries() + "1_*"
    assert spark.catalog.listTables(pattern=gone)
    monkeypatch.setattr("tallyhouse.sources.versions.LARGE_BUCKET", 0)
    uneven = staged.withColumn("invoice", F.lit("i")).withColumn("stock_code", F.lit("s"))
    table = tables.stage_rows(uneven, path, buckets=16)
    table.expire()
    assert table.version().buckets is None and "Exchange" in grouped(tables.accepted(table))
    assert seen(tables.accepted(table)) == list(range(200))
    assert not spark.catalog.listTables(pattern=gone)
    # An empty load has no buckets, and no rows.
    table = tables.stage_rows(staged.limit(0), path, buckets=4)
    assert tables.accepted(table).count() == 0


def test_loads_read_small_splits(spark, tmp_path):
    """A load reads a quarter of the session's split per task, and leaves the setting as it was."""
    settings = {"spark.sql.files.maxPartitionBytes": "64m", "spark.sql.files.minPartitionNum": "1"}
    old = {name: spark.conf.get(name, None) for name in settings}
    path = str(tmp_path / "landed")
    rows = [(str(n), "A", "x", 1, frames.DAY, 1, n, "UK") for n in range(80)]
    frames.landed(spark, rows).repartition(8).write.parquet(path)
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        given = landing.canonical_columns(landing.scan_raw(spark, path))
        loaded = tables.load_staging(given, str(tmp_path / "staging"), frames.DAY)
        assert given.select(F.spark_partition_id()).distinct().count() == 1
        assert loaded.frame.select((F.col("id") - 1).bitwiseAND(-1 << 33)).distinct().count() > 1
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffle_files(spark):
    """Names of the shuffle files that a local session has on disk."""
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = store.getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are new since ``before`` and stay; they are removed behind the job's back, which takes a moment."""
    until = time.monotonic() + 5
    while (new := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.1)
    return new


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    grouped = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count()
    was, before = spark.conf.get(name), shuffle_files(spark)
    written = session.materialise(grouped, "grouped")
    table = VersionedTable(spark, str(tmp_path / "table"))
    table.replace(grouped, ("k",))
    assert not left_over(spark, before)
    assert written.count() == table.read().count() == 7 and spark.conf.get(name) == was


def test_a_written_step_goes_when_the_next_is_there(spark):
    relay = session.Relay(spark, "relay-test")
    first = relay.step(spark.range(10))
    second = relay.step(first.where("id > 3"))
    scratch = VersionedTable(spark, session.scratch_folder(spark))
    assert second.count() == 6 and len([f for f in scratch._list() if f.startswith("relay-test")]) == 1
    relay.end()
    relay.end()
    assert not [f for f in scratch._list() if f.startswith("relay-test")]
