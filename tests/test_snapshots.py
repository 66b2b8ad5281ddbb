"""Snapshot pointers, manifests, content checks, previews, the stream's log
and runs that go on where one stopped."""

import os

import pytest
from pyspark.sql import functions as F

from tripflow.plans import month as M
from tripflow.plans.month import run_month
from tripflow.sources import io, snapshots
from tripflow.sources.fixture import load_trips
from tripflow.sources.io import content_checksum, land, preview, read_layer, verify_write, write_layer
from tripflow.sources.layout import Layout
from tripflow.streaming import land_incrementally, landing

from conftest import SF_SMALL, plan_text


class Killed(BaseException):
    """Ends a step where a killed process would, without clean-up."""


def versions(path):
    return sorted(n for n in os.listdir(path) if n.startswith("v-"))


def test_a_writer_killed_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_layer(spark.range(5), path)
    reader = read_layer(spark, path)

    def killed(*_):
        raise Killed

    for module in (io,):
        monkeypatch.setattr(module, "switch", killed)
    for write in (lambda: write_layer(spark.range(9), path), lambda: land(spark, spark.range(9), path, if_exists="replace")):
        with pytest.raises(Killed):
            write()
        assert read_layer(spark, path).count() == 5 == reader.count()
    assert len(versions(path)) == 3  # the leftovers of the killed writers
    monkeypatch.undo()
    write_layer(spark.range(7), path)
    assert read_layer(spark, path).count() == 7 and len(versions(path)) == 1


def test_a_writer_killed_after_the_switch_leaves_the_new_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_layer(spark.range(5), path)

    def killed(*_):
        raise Killed

    monkeypatch.setattr(io, "sweep", killed)
    with pytest.raises(Killed):
        write_layer(spark.range(9), path)
    assert read_layer(spark, path).count() == 9 and len(versions(path)) == 2
    monkeypatch.undo()
    snapshots.sweep(spark, path)
    assert read_layer(spark, path).count() == 9 and len(versions(path)) == 1
    assert len([n for n in os.listdir(f"{path}/_current") if not n.startswith(".")]) == 1


def test_one_entry_per_version_number_and_plain_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)  # given files: a version of their own
    assert snapshots.layer_path(spark, path) == path and read_layer(spark, path).count() == 3
    write_layer(spark.range(4), path)
    assert read_layer(spark, path).count() == 4
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == ["_current", *versions(path)]
    with pytest.raises(IOError, match="current already"):
        snapshots.switch(spark, path, versions(path)[0])
    for i in range(11):  # numbers, not names, decide
        write_layer(spark.range(i), path)
    assert read_layer(spark, path).count() == 10


def test_a_layer_is_planned_from_its_manifest(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, None), ("b", 2, 2.5)], "k string, v int, x double")
    write_layer(rows, path, partition_by=["k"])
    folder = f"{path}/{versions(path)[0]}"
    for name in os.listdir(f"{folder}/k=a"):  # a file that can't be opened
        if name.endswith(".parquet"):
            open(f"{folder}/k=a/{name}", "w").write("not parquet")
    df = read_layer(spark, path)
    assert df.dtypes == [("v", "int"), ("x", "double"), ("k", "string")]
    assert "PushedFilters: [IsNotNull(v), EqualTo(v,2)]" in plan_text(df.where("k = 'b' and v = 2"))
    assert [tuple(r) for r in df.where("k = 'b'").collect()] == [(2, 2.5, "b")]
    with pytest.raises(io.SchemaError, match="columns"):
        write_layer(rows.withColumn("v", F.lit("text")), path, partition_by=["k"], only_partitions=True)


def test_content_check_sees_one_changed_value(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id / 7D AS x", "CASE WHEN id % 3 = 0 THEN 'a' END AS s", "map('k', id) AS m")
    same = rows.repartition(5).select("s", "m", "x", "id")
    assert content_checksum(rows) == content_checksum(same)
    changed = rows.withColumn("x", F.when(F.col("id") == 500, F.lit(0.0)).otherwise(F.col("x")))
    moved = rows.selectExpr("id", "CASE WHEN id = 3 THEN NULL ELSE x END AS x", "CASE WHEN id = 3 THEN 'a' ELSE s END AS s", "m")
    twice = rows.where("id != 1").unionAll(rows.where("id = 2"))
    assert len({content_checksum(d) for d in (rows, changed, moved, twice)}) == 4
    target = str(tmp_path / "t")
    report = land(spark, rows, target, verify="content").first()
    assert report["same_content"] and report["rows_written"] == 1000
    manifest = snapshots.Manifest.load(spark, snapshots.layer_path(spark, target))
    assert (manifest.rows, manifest.checksum) == (1000, content_checksum(read_layer(spark, target)))
    other = str(tmp_path / "changed")
    changed.write.parquet(other)
    with pytest.raises(IOError, match="checksum"):
        verify_write(spark, rows.schema, 1000, other, manifest.checksum)


def test_preview_is_the_same_for_any_layout(spark, tmp_path):
    trips = load_trips(spark, SF_SMALL)
    want = [tuple(r) for r in preview(trips, 5).collect()]
    assert len(want) == 5 and want == [tuple(r) for r in preview(trips.repartition(7), 5).collect()]
    report = land(spark, trips, str(tmp_path / "b"), sample_rows=5).first()
    assert len(report["sample"]) == 5
    again = land(spark, trips, str(tmp_path / "b"), sample_rows=5).first()
    assert again["status"] == "skipped" and again["sample"] == report["sample"]
    assert land(spark, trips.limit(0), str(tmp_path / "e"), sample_rows=5).first()["sample"] == []


def test_stream_counts_from_its_log_and_lists_no_old_files(spark, tmp_path, monkeypatch):
    src, target, ckpt = (str(tmp_path / x) for x in ("raw", "bronze", "ckpt"))
    read = []
    real = landing._entries

    def watched(spark, target, names):
        read.append(list(names))
        return real(spark, target, names)

    monkeypatch.setattr(landing, "_entries", watched)
    rows = 0
    for i in range(13):  # over a compaction of the log
        spark.range(i + 1).repartition(1).write.mode("append").parquet(src)
        read.clear()
        got = land_incrementally(spark, src, target, ckpt).first()["rows_read"]
        assert got == i + 1
        rows += got
        if not any(n.endswith(".compact") for names in read for n in names):
            assert read == [[str(i)]]
    assert any(n.endswith(".compact") for n in os.listdir(f"{target}/_spark_metadata"))
    assert land_incrementally(spark, src, target, ckpt).first()["rows_read"] == 0
    assert read_layer(spark, target).count() == rows


def test_a_failed_run_goes_on_without_a_second_dedupe(spark, tmp_path, monkeypatch):
    trips, layout = load_trips(spark, SF_SMALL), Layout(str(tmp_path / "lake"), "2026_01")

    def fails(*_, **__):
        raise RuntimeError("gold failed")

    monkeypatch.setattr(M, "refresh_gold", fails)
    with pytest.raises(RuntimeError, match="gold failed"):
        run_month(spark, trips, layout)
    monkeypatch.undo()
    builds = []
    real = M.build_silver
    monkeypatch.setattr(M, "build_silver", lambda *a, **k: builds.append(1) or real(*a, **k))
    run = run_month(spark, trips, layout)
    assert run.steps_run == ["gold", "reports"] and not builds
    funnel = {r["name"]: r["rows_out"] for r in run.reports["funnel"].collect()}
    assert funnel["outliers"] == run.built.silver.count() == run.gold["by_hour"].agg({"total_trips": "sum"}).first()[0]
    assert run.built.bounds.count() == 3 and run.figures["duplicates"].first()["rows"] == funnel["read"]
    # finished: nothing runs again, and other inputs run all that depend on them
    assert run_month(spark, trips, layout).steps_run == [] and not builds
    fewer = trips.where("l_orderkey % 2 = 0")
    again = run_month(spark, fewer, layout, if_exists="replace")
    assert again.steps_run == ["land", "silver", "profile", "gold", "reports"]
    assert again.gold["by_hour"].agg({"total_trips": "sum"}).first()[0] == again.built.silver.count()
    assert run_month(spark, fewer, layout, resume=False).steps_run == ["silver", "profile", "gold", "reports"]


def test_a_resumed_run_without_its_staged_table_builds_silver_again(spark, tmp_path, monkeypatch):
    trips, layout = load_trips(spark, SF_SMALL), Layout(str(tmp_path / "lake"), "2026_01")
    monkeypatch.setattr(M, "profile", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        run_month(spark, trips, layout)
    monkeypatch.undo()
    staged = M.Ledger(spark, layout.ledger)
    import json

    left = json.loads(snapshots.read_text(spark, f"{staged.path}/silver.json"))["left"]
    snapshots.remove(spark, left["staged_path"])
    assert run_month(spark, trips, layout).steps_run == ["silver", "profile", "gold", "reports"]
