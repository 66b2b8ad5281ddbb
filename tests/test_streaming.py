"""Incremental landing: each raw file is landed once, re-runs skip it."""

from tripflow.sources.fixture import load_trips
from tripflow.streaming import land_incrementally

from conftest import SF_SMALL


def test_incremental_landing_lands_each_file_once(spark, tmp_path):
    trips = load_trips(spark, SF_SMALL)
    src, target, ckpt = str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    first, second = trips.filter("l_orderkey % 2 = 0"), trips.filter("l_orderkey % 2 = 1")
    first.write.mode("append").parquet(src)
    r1 = land_incrementally(spark, src, target, ckpt).first()
    assert r1["status"] == "landed" and r1["rows_read"] == first.count()
    r2 = land_incrementally(spark, src, target, ckpt).first()
    assert r2["status"] == "up to date" and r2["rows_read"] == 0
    second.write.mode("append").parquet(src)
    r3 = land_incrementally(spark, src, target, ckpt).first()
    assert r3["rows_read"] == second.count()
    landed = spark.read.parquet(target)
    assert landed.count() == trips.count()
    assert landed.exceptAll(trips).count() == 0


def test_incremental_landing_counts_rows_of_all_micro_batches(spark, tmp_path):
    trips = load_trips(spark, SF_SMALL)
    src, target, ckpt = str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    trips.repartition(5).write.parquet(src)  # five files, one per micro-batch
    r = land_incrementally(spark, src, target, ckpt, max_files_per_trigger=1).first()
    assert r["rows_read"] == trips.count()
