"""The nested rank index against brute force, and its number of jobs."""

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.operators.outliers import iqr_candidates, iqr_filter
from tripflow.operators.quantile_select import QuantileTarget, discrete_rank, exact_quantiles
from tripflow.operators.rank_index import RankTarget, ranked_values

from conftest import plan_text

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)
INF = float("inf")


def brute(values, p):
    xs = sorted(v for v in values if v is not None and v == v)
    return xs[discrete_rank(len(xs), p) - 1] if xs else None


ODD = [None, float("nan"), INF, -INF, 0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.7976931348623157e308, -1.7976931348623157e308,
       1.0, 1.0000000000000002, 0.9999999999999999, 1e-300, 12.34, 12.340000000000002, -7.5]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.sampled_from(ODD), st.floats(-1e3, 1e3)), st.integers(0, 3)), max_size=80))
def test_equals_brute_force_under_filters(spark, rows):
    df = spark.createDataFrame(rows, "x double, g int")
    targets = [RankTarget((g, p), p, None if g is None else F.col("g") >= g) for g in (None, 1, 3) for p in PROBS]
    got = ranked_values(df, "x", targets)
    for t in targets:
        g, p = t.key
        assert got[t.key] == brute([x for x, h in rows if g is None or h >= g], p), t.key


def test_integers_decimals_and_close_values(spark):
    big = 9007199254740993
    rows = [(big + i, Decimal(f"{i}.{i:02d}"), 1.0 + i * 2**-52) for i in range(40)]
    df = spark.createDataFrame(rows, "n long, d decimal(12,2), `x.y` double")
    for i, c in enumerate(df.columns):
        for p in PROBS:
            assert ranked_values(df, c, [RankTarget("q", p)])["q"] == brute([r[i] for r in rows], p)


def test_equals_bucket_selection_with_a_hot_value(spark):
    df = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 9.5D ELSE (id * 7919 % 100003) / 97D END AS x", "id % 11 AS g").repartition(7)
    wheres = {m: F.col("g") < m for m in (1, 4, 11)}
    got = ranked_values(df, "x", [RankTarget((m, p), p, w) for m, w in wheres.items() for p in PROBS])
    assert got == exact_quantiles(df, [QuantileTarget((m, p), "x", p, w) for m, w in wheres.items() for p in PROBS])


def test_no_rows_and_no_targets(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert ranked_values(df, "x", [RankTarget("q", 0.5)]) == {"q": None}
    assert ranked_values(df, "x", []) == {}


@pytest.fixture
def plain_jobs(spark):
    """One Spark job per action (adaptive stages are jobs of their own)."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    sc.setJobGroup("rank-index", "jobs of a tuning")
    yield lambda: len(tracker.getJobIdsForGroup("rank-index"))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_tuning_takes_a_job_per_column_and_one(spark, plain_jobs):
    rng = random.Random(1)
    rows = [(rng.lognormvariate(1, 1), rng.gauss(20, 8), rng.choice([1.0, 2.0, 50.0])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    ms = (0.25, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0)
    before = plain_jobs()
    table = {r["multiplier"]: r["rows_after"] for r in iqr_candidates(df, ["a", "b", "c"], ms).table.collect()}
    assert plain_jobs() - before == 4
    assert table == {m: iqr_filter(df, ["a", "b", "c"], m).count() for m in ms}


def test_values_are_shuffled_once(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plans, original = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: plans.append(self) or original(self))
    df = spark.range(3000).selectExpr("id * 7919 % 1009 / 7D AS x", "id % 3 AS g").repartition(3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked_values(df, "x", [RankTarget(p, p, F.col("g") < 2) for p in (0.25, 0.75)])
        plan = plan_text(plans[-1]).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # values and slices each have one exchange, read again by the levels below
    assert plan.count("ReusedExchange") >= 2 and plan.count("Range") <= 1
