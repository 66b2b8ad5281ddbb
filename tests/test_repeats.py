"""Distinct rows by hashes first: the same rows and copies as by grouping all,
and what is moved."""

import math

import pytest
from pyspark.sql import functions as F

from tripflow.operators import repeats as R
from tripflow.operators.rules import COPIES, with_copies
from tripflow.plans import specs
from tripflow.plans.silver import stage_tagged
from tripflow.sources.fixture import load_trips

from conftest import SF_SMALL, plan_text


def agree(df):
    got, want = R.distinct_with_copies(df), with_copies(df)
    assert got.schema == want.schema
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    return got


@pytest.fixture
def odd(spark):
    """Nulls, NaN, both zeros, copies, and one row half of the time."""
    x = "CASE WHEN id % 3 = 0 THEN -0.0D WHEN id % 3 = 1 THEN double('nan') ELSE id END AS x"
    some = spark.range(3000).selectExpr(x, "CASE WHEN id % 2 = 0 THEN 'a' END AS n", "id % 700 AS k")
    zero = spark.sql("SELECT 0.0D AS x, CAST(NULL AS STRING) AS n, 0L AS k")
    hot = spark.range(4000).selectExpr("1.5D AS x", "'h' AS n", "7L AS k")
    return some.unionAll(zero).unionAll(some.where("k < 9")).unionAll(hot).repartition(5)


def test_equals_grouping(spark, odd):
    rows = agree(odd).collect()
    assert not any(r["x"] == 0 and math.copysign(1, r["x"]) < 0 for r in rows)
    agree(odd.limit(0))
    agree(load_trips(spark, SF_SMALL))


def test_hot_rows_and_shared_bits(odd, monkeypatch):
    monkeypatch.setattr(R, "HOT_SHARE", 0.5)
    monkeypatch.setattr(R, "HOT_KEPT", 3)
    assert 1 <= len(R._hot(odd)) <= 3
    agree(odd)
    monkeypatch.setattr(R, "FILTER_BITS", 2 * R.BLOCK_BITS)
    monkeypatch.setattr(R, "HOT_SEEN", 1 << 40)
    agree(odd)
    monkeypatch.setattr(R, "_position", lambda p: F.pmod(p, F.lit(8)))  # nearly every row shares a bit
    agree(odd)


def test_other_types_are_grouped(spark):
    df = spark.sql("SELECT * FROM VALUES (array(0.0D), 1), (array(-0.0D), 1), (array(1.0D), 2) AS t(a, b)")
    assert "_set" not in plan_text(R.distinct_with_copies(df))
    agree(df)


def test_staging_moves_hashes_and_rows_with_copies(spark, tmp_path):
    trips = load_trips(spark, SF_SMALL).localCheckpoint()
    repeated = with_copies(trips).where(F.col(COPIES) > 1).count()
    seen = []
    original = R.with_copies
    R.with_copies = lambda df: seen.append(df.count()) or original(df)
    try:
        staged = stage_tagged(trips, specs.cleaning_steps(trips), str(tmp_path / "staged"))
    finally:
        R.with_copies = original
    assert staged.count() == trips.distinct().count()
    assert seen and seen[0] <= 2 * repeated + 10  # of 6057 rows, those with copies
