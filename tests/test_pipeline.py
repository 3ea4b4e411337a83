from datetime import datetime, timedelta

import frames
import pytest
from pyspark.sql import functions as F

from tallyhouse import __main__ as command
from tallyhouse.plans import pipeline
from tallyhouse.sources import tables

AS_OF = datetime(2010, 4, 2)


def land(spark, folder, country="UK", fmt="parquet"):
    rows = [
        (
            ("C" if i % 9 == 0 else "") + str(i // 3),
            f"P{i % 7:03d}",
            None if i % 7 == 3 else "thing",
            1 + i % 5,
            frames.DAY + timedelta(hours=7 * i),
            1.25,
            None if i % 11 == 0 else i % 6,
            country if i % 13 else "FR",
        )
        for i in range(90)
    ]
    writer = frames.landed(spark, rows + rows[:5]).write
    writer.option("header", True).format(fmt).save(str(folder))


@pytest.mark.parametrize("buckets", [None, 4])
def test_full_run(spark, tmp_path, monkeypatch, buckets):
    def again(*args):
        raise AssertionError("the landing is read a second time")

    monkeypatch.setattr(tables, "cleaning_stats", again)
    land(spark, tmp_path / "in")
    done = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), AS_OF, buckets=buckets)
    assert frames.one(done.gate)["overall_status"] == "PASS"
    assert done.results["Load_Warnings"].count() == 0
    summary = frames.one(done.results["Run_Summary"])
    assert summary["rows_processed"] == 81 and summary["rows_rejected"] == 14
    assert summary["drop_rate"] == 14.74 and summary["best_country"] == "UK"
    stages = ["staging_seconds", "star_seconds", "gate_seconds", "checks_seconds", "report_seconds"]
    assert summary["processing_time"] == pytest.approx(sum(summary[s] for s in stages), abs=0.01) and summary["processing_time"] > 0
    assert summary["fact_rows"] == done.star.fact.count() == 81
    assert summary["dimension_tables"] == 4
    dashboard = frames.one(done.results["Quality_Dashboard"])
    assert (dashboard["quality_score"], dashboard["overall_status"]) == (100.0, "PASS")
    assert dashboard["last_warehouse_load"] == AS_OF
    assert len(done.sheets) == 7 and len(done.results) == 20
    assert (tmp_path / "out" / "quality_reports" / "report_ts=20100402_0800").is_dir()
    assert done.retained.rows_deleted == 0
    assert done.retained.frame.count() == 81
    total = done.star.fact.where("not is_return").agg(F.sum("total_amount")).first()[0]
    assert summary["total_revenue"] == total


def test_gate_stops_the_report(spark, tmp_path):
    land(spark, tmp_path / "in", country=None)
    with pytest.raises(pipeline.GateFailed, match="integrity="):
        pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), AS_OF)
    assert (tmp_path / "out" / "fact_sales").is_dir()
    assert not (tmp_path / "out" / "quality_reports").exists()


def test_clean_up_trouble_does_not_fail_the_run(spark, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("disk gone")

    land(spark, tmp_path / "in")
    monkeypatch.setattr(pipeline, "apply_retention", broken)
    done = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), AS_OF)
    assert done.retained is None


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    # The other tests of this session still need their intermediate tables.
    removed = []
    monkeypatch.setattr(command, "remove_scratch", removed.append)
    land(spark, tmp_path / "in", fmt="csv")
    common = ["--format", "csv", "--as-of", "2010-04-02T00:00:00"]
    assert command.main([str(tmp_path / "in"), str(tmp_path / "out"), *common]) == 0
    printed = capsys.readouterr().out
    assert "outlier_days" in printed and "best_country" in printed and removed == [spark]
    land(spark, tmp_path / "bad", country=None, fmt="csv")
    assert command.main([str(tmp_path / "bad"), str(tmp_path / "out2"), *common]) == 1
