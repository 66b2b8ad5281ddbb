"""Two months side by side; landing that loses nothing; checked inputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tripflow.columns import TRIP as C
from tripflow.operators.profile import duplicate_stats
from tripflow.operators.rules import with_copies
from tripflow.plans.month import run_month
from tripflow.plans.profile_job import profile
from tripflow.plans.silver import build_silver
from tripflow.sources.fixture import load_trips
from tripflow.sources.io import SchemaError, committed, land, read_layer, write_layer
from tripflow.sources.layout import Layout
from tripflow.streaming import land_incrementally

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def trips(spark):
    return load_trips(spark, SF_SMALL)


def test_two_months_keep_their_gold(spark, trips, tmp_path):
    base = str(tmp_path / "lake")
    january, february = Layout(base, "2026_01"), Layout(base, "2026_02")
    run_month(spark, trips, january)
    total = lambda lay: read_layer(spark, lay.gold("by_hour")).agg({"total_trips": "sum"}).first()[0]
    before = total(january)
    later = trips.withColumns({c: F.col(c) + F.expr("INTERVAL 31 DAYS") for c in (C.pickup, C.dropoff)})
    run = run_month(spark, later, february, year=2026, month=2)
    kept = {r["name"]: r["rows_out"] for r in run.reports["funnel"].collect()}
    assert total(january) == before and total(february) == kept["outliers"] > 0.8 * before
    assert [r["issue"] for r in run.figures["issues"].collect() if r["issue"].startswith("outside")] == ["outside 2026-02"]
    assert not [d for d in os.listdir(base) if ".new-" in d or ".old-" in d]


def test_files_with_other_columns_lose_nothing(spark, trips, tmp_path):
    src, target = str(tmp_path / "raw"), str(tmp_path / "bronze")
    trips.limit(10).write.mode("append").parquet(src)
    trips.limit(5).withColumn("extra", F.lit("x")).write.mode("append").parquet(src)
    report = land(spark, src, target).first()
    back = read_layer(spark, target)
    assert report["same_schema"] and report["rows_written"] == 15
    assert back.where("extra = 'x'").count() == 5
    clash = str(tmp_path / "clash")
    trips.limit(3).write.mode("append").parquet(clash)
    trips.limit(3).withColumn(C.fare, F.lit("text")).write.mode("append").parquet(clash)
    with pytest.raises(Exception, match="(?i)merge"):
        land(spark, clash, str(tmp_path / "b2"))


def test_stream_refuses_columns_it_would_lose(spark, trips, tmp_path):
    src, target, ckpt = (str(tmp_path / x) for x in ("raw", "bronze", "ckpt"))
    trips.limit(10).write.mode("append").parquet(src)
    assert land_incrementally(spark, src, target, ckpt).first()["rows_read"] == 10
    trips.limit(4).withColumn("extra", F.lit("x")).write.mode("append").parquet(src)
    with pytest.raises(SchemaError, match="extra"):
        land_incrementally(spark, src, target, ckpt)


def test_uncommitted_target_is_not_skipped(spark, trips, tmp_path):
    target = str(tmp_path / "bronze")
    trips.limit(10).write.parquet(target)
    os.remove(f"{target}/_SUCCESS")
    assert not committed(spark, target)
    report = land(spark, trips, target).first()
    assert report["status"] == "landed" and report["rows_written"] == trips.count()
    assert land(spark, trips, target).first()["status"] == "skipped"


def test_replace_replaces_all_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_layer(rows, path, partition_by=["k"])
    write_layer(rows.where("k = 'a'"), path, partition_by=["k"])
    assert [r["k"] for r in read_layer(spark, path).collect()] == ["a"]
    write_layer(rows.where("k = 'b'"), path, partition_by=["k"], only_partitions=True)
    assert sorted(r["k"] for r in read_layer(spark, path).collect()) == ["a", "b"]
    assert land(spark, rows.where("k = 'b'"), path, if_exists="replace", partition_by=["k"]).first()["rows_written"] == 1


def test_a_failed_overwrite_keeps_the_old_layer(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.range(5), path)
    with pytest.raises(Exception):
        write_layer(spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert read_layer(spark, path).count() == 5
    assert os.listdir(tmp_path) == ["t"]


def test_zoned_and_missing_columns_are_refused(spark, trips):
    zoned = trips.withColumn(C.pickup, F.col(C.pickup).cast("timestamp"))
    for job in (build_silver, profile):
        with pytest.raises(SchemaError, match=C.pickup):
            job(zoned)
        with pytest.raises(SchemaError, match="missing"):
            job(trips.drop(C.fare))


def test_empty_bronze(spark, trips, tmp_path):
    built = build_silver(trips.limit(0), target=str(tmp_path / "silver"))
    assert built.silver.count() == 0 and built.rejects().count() == 0
    assert [r["rows_out"] for r in built.funnel().collect()] == [0] * 6


def test_dotted_column_names(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "`a.b` int, `c``d` string")
    assert duplicate_stats(df).first()["duplicates"] == 1
    assert with_copies(df).count() == 2


def test_month_of_a_year_end():
    from tripflow.functions.expr import month_bounds

    assert month_bounds(2025, 12) == (dt.datetime(2025, 12, 1), dt.datetime(2026, 1, 1))


def test_month_from_the_command_line(spark, trips, tmp_path, monkeypatch, capsys):
    from tripflow.__main__ import main

    raw = str(tmp_path / "raw")
    trips.write.parquet(raw)
    monkeypatch.setenv("TRIPFLOW_BASE", str(tmp_path / "lake"))
    assert main(["month", "--source", raw, "--year", "2026", "--month", "1"]) == 0
    assert "landed" in capsys.readouterr().out
    assert main(["profile", "--year", "2026", "--month", "1"]) == 0
    assert read_layer(spark, Layout(str(tmp_path / "lake"), "2026_01").gold("by_hour")).count() == 24
