"""Bounded sketches: heavy hitters with their bound, quantiles by day."""

import random

import pytest
from pyspark.sql import functions as F

from tripflow.operators import heavy as H
from tripflow.operators import sketches as S
from tripflow.operators.summarise import Label, Measure, Summary, summarise
from tripflow.plans.gold import refresh_sketches
from tripflow.sources.layout import Layout

from conftest import plan_text

SPEC = Summary(
    "top", ("a", "b"), (Measure("n", "count"), Measure("s", "sum", "x", 2)),
    labels=(Label("name", "a", {0: "zero"}, "other"),), order=(("n", False),), limit=5,
)


def many_keys(spark, keys):
    """Every key once or twice, and a few often, one of them with a null."""
    rows = spark.range(keys * 3 // 2).selectExpr(f"CAST(id % {keys} AS INT) AS a", "'k' AS b", "id / 7D AS x")
    often = spark.range(60_000).selectExpr("CAST(id % 3 AS INT) AS a", "CASE WHEN id % 2 = 0 THEN 'hot' END AS b", "1D AS x")
    return rows.unionAll(often).repartition(6)


def test_a_million_keys_shuffle_only_candidates(spark):
    df = many_keys(spark, 1_000_000).select("*", F.lit(1).alias("_h"), F.lit(2).alias("h"))
    some, bound = H.candidates(df, SPEC.keys)
    assert some.count() <= H.TRACKED and bound < 1000
    got = H.top_groups(df, SPEC, "n").collect()
    assert got == summarise(df, SPEC).collect() and got[0]["n"] == 10_000 and len(got) == 5
    # rows are cut to the candidates' before the aggregate and its shuffle
    kept = df.withColumn("k", F.xxhash64("a")).join(F.broadcast(some), F.col("k") == some["h"])
    plan = plan_text(kept.groupBy("a", "b").count())
    assert plan.index("BroadcastHashJoin") > plan.index("HashAggregate")


def test_falls_back_where_the_bound_does_not_separate(spark, monkeypatch):
    df = spark.range(3000).selectExpr("CAST(id % 1000 AS INT) AS a", "'k' AS b", "1D AS x")
    calls = []
    real = H.summarise
    monkeypatch.setattr(H, "summarise", lambda d, s: calls.append(1) or real(d, s))
    assert H.top_groups(df, SPEC, "n", tracked=16).collect() == summarise(df, SPEC).collect()
    assert len(calls) == 2  # the candidates', then all
    empty = H.top_groups(df.limit(0), SPEC, "n")
    assert empty.collect() == [] and empty.columns == summarise(df, SPEC).columns
    with pytest.raises(ValueError, match="limit"):
        H.top_groups(df, Summary("x", ("a",), SPEC.measures), "n")


def test_a_key_beyond_the_sketch_is_within_its_bound(spark):
    rng = random.Random(5)
    rows = [(min(int(rng.paretovariate(0.8)), 5000),) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "a int").repartition(5)
    some, bound = H.candidates(df, ("a",), tracked=64)
    held = {r[0] for r in some.collect()}
    for a, n in df.groupBy("a").count().collect():
        h = spark.range(1).select(F.xxhash64(F.lit(a).cast("int"), F.lit(False))).first()[0] if n > bound else None
        assert n <= bound or h in held, (a, n)


def exact_share(values, v):
    return sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)


def test_merged_days_stay_within_the_rank_bound(spark, tmp_path):
    rng = random.Random(8)
    rows = [(d, rng.lognormvariate(2, 1), rng.choice([None, float("nan"), float("inf"), 5.0])) for d in range(40) for _ in range(500)]
    df = spark.createDataFrame(rows, "day int, x double, y double")
    days = S.quantile_sketches(df, ("day",), ("x", "y"))
    months = S.merged_quantiles(days, ("x", "y"), (0.05, 0.5, 0.95)).collect()  # one merge over all days
    for r in months:
        values = [x for _, x, _ in rows] if r["column"] == "x" else [5.0]
        low, high = exact_share(values, r["value"])
        assert low - r["rank_error"] <= r["prob"] <= high + r["rank_error"]
    assert S.rank_error() < 0.01
    few = S.merged_quantiles(days.where("day < 3"), ("x",), (0.5,)).first()["value"]
    low, high = exact_share([x for d, x, _ in rows if d < 3], few)
    assert low - S.rank_error() <= 0.5 <= high + S.rank_error()
    assert all(r["within"] for r in S.within_bound(df, S.merged_quantiles(days, ("x", "y"), (0.1, 0.9))).collect())
    wrong = spark.createDataFrame([("x", 0.5, 1e9, 0.007)], "column string, prob double, value double, rank_error double")
    assert not S.within_bound(df, wrong).first()["within"]
    none = S.merged_quantiles(days.where("day > 99"), ("x",), (0.5,)).first()
    assert none["value"] is None


def test_sketches_are_refreshed_by_day(spark, tmp_path):
    from tripflow.columns import TRIP as C
    from tripflow.plans import specs

    layout = Layout(str(tmp_path / "lake"))
    rows = spark.range(4000).selectExpr(
        f"date_add(date'2026-01-01', CAST(id % 4 AS INT)) AS {C.date}", *[f"CAST(id AS DOUBLE) AS {x}" for x in specs.range_columns()]
    )
    refresh_sketches(rows.where(F.dayofmonth(C.date) <= 2), layout)
    refresh_sketches(rows.where(F.dayofmonth(C.date) == 2).limit(5), layout)  # came in part, then whole
    stored = refresh_sketches(rows.where(F.dayofmonth(C.date) >= 2), layout)
    assert stored.count() == 4
    for r in S.merged_quantiles(stored, specs.range_columns(), (0.25, 0.75)).collect():
        assert abs(r["value"] - 4000 * r["prob"]) <= 4000 * S.rank_error() + 2
