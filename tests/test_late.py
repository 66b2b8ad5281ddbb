"""A month in parts gives the silver of the month in one go."""

import pytest
from pyspark.sql import functions as F

from tripflow.operators import bloom as B
from tripflow.plans.late import add_part, build_silver_from_parts, parts
from tripflow.plans.silver import build_silver
from tripflow.sources.fixture import load_trips
from tripflow.sources.layout import Layout

from conftest import SF_SMALL


def test_filter_finds_all_its_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    blocks = B.blocks_for(20_000)
    table = B.bloom_table(keys, blocks)
    assert table.count() == blocks == 8
    assert B.might_hold(keys, table, blocks).count() == 20_000
    others = spark.range(10**6, 10**6 + 20_000).select(F.xxhash64("id").alias("key"))
    assert B.might_hold(others, table, blocks).count() < 600
    empty = B.bloom_table(keys.limit(0), B.blocks_for(0))
    assert B.might_hold(keys, empty, 1).count() == 0


@pytest.fixture(scope="module")
def trips(spark):
    return load_trips(spark, SF_SMALL)


def test_month_in_parts_equals_the_month_in_one_go(spark, trips, tmp_path):
    whole = build_silver(trips, target=str(tmp_path / "silver"))
    layout = Layout(str(tmp_path / "lake"), "2026_01")
    key = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(10))
    first = trips.where(key < 6)
    second = trips.where(key >= 5)  # a tenth of the rows comes twice
    extra = trips.where(key == 0).unionAll(trips.where(key == 9))  # and some once more
    assert add_part(first, layout).again == 0
    built_early = build_silver_from_parts(spark, layout)
    assert built_early.silver.count() > 0
    for part, rows in ((second, trips.where(key == 5)), (extra, extra)):
        got = add_part(part, layout)
        again = rows.distinct().count()
        assert got.again == again and got.new == part.distinct().count() - again
        # the filters leave out almost all that is new
        assert again <= got.compared <= again + 0.05 * got.new + 20
    assert len(parts(spark, layout)) == 3
    built = build_silver_from_parts(spark, layout)
    assert built.multiplier == whole.multiplier and built.tuning.bounds == whole.tuning.bounds
    assert built.silver.columns == whole.silver.columns
    assert built.silver.exceptAll(whole.silver).count() == 0 == whole.silver.exceptAll(built.silver).count()
    all_rows = first.unionAll(second).unionAll(extra)
    once = build_silver(all_rows, target=str(tmp_path / "again"))
    assert built.funnel().orderBy("step").collect() == once.funnel().orderBy("step").collect()
    rejects = lambda b: b.rejects().groupBy("reject_step").agg(F.sum("copies"), F.count("*")).orderBy("reject_step").collect()
    assert rejects(built) == rejects(once)


def test_a_part_without_its_rows_does_not_count(spark, trips, tmp_path, monkeypatch):
    from tripflow.plans import late

    layout = Layout(str(tmp_path / "lake"), "2026_01")
    real = late.write_layer

    def stops(df, path, **how):
        if path.endswith("/rows"):
            raise RuntimeError("killed")
        return real(df, path, **how)

    monkeypatch.setattr(late, "write_layer", stops)
    with pytest.raises(RuntimeError):
        add_part(trips.limit(50), layout)
    monkeypatch.undo()
    assert parts(spark, layout) == []
    assert add_part(trips.limit(50), layout).number == 0 and len(parts(spark, layout)) == 1
