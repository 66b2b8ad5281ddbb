"""Boundary cases of the pipeline's rules, measures and tuning, through the
declared specs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.columns import TRIP as C
from tripflow.operators.outliers import choose_multiplier, iqr_filter, iqr_filter_with_bounds
from tripflow.operators.rules import clean
from tripflow.operators.summarise import summarise
from tripflow.plans import specs
from tripflow.sources.fixture import load_trips

from conftest import SF_SMALL

LIMITS = [
    (C.distance, 0.0, False), (C.distance, 0.01, True), (C.distance, 200.0, True), (C.distance, 200.01, False),
    (C.fare, 2.49, False), (C.fare, 2.5, True), (C.fare, 500.0, True), (C.fare, 500.01, False),
    (C.total, 0.0, False), (C.total, 0.01, True), (C.total, 1000.0, True), (C.total, 1000.01, False),
    (C.passengers, 0, False), (C.passengers, 1, True), (C.passengers, 6, True), (C.passengers, 7, False),
    (C.tip, -0.01, False), (C.tip, 0.0, True), (C.vendor, 3, False), (C.vendor, 2, True),
]


@pytest.fixture(scope="module")
def sound(spark):
    """One trip that every rule keeps."""
    rows = clean(load_trips(spark, SF_SMALL), specs.cleaning_steps(load_trips(spark, SF_SMALL)))
    return rows.limit(1)


def test_limits_are_inclusive_where_they_should_be(spark, sound):
    row = sound.first()
    trips, schema = [], sound.schema
    for i, (column, value, _) in enumerate(LIMITS):
        trips.append(tuple({**row.asDict(), "l_orderkey": i, column: value}.values()))
    df = spark.createDataFrame(trips, schema)
    kept = {r["l_orderkey"] for r in clean(df, specs.cleaning_steps(df)).collect()}
    assert kept == {i for i, (_, _, keep) in enumerate(LIMITS) if keep}


def test_durations_and_the_month(spark, sound):
    row, schema = sound.first().asDict(), sound.schema
    start = dt.datetime(2026, 1, 31, 23, 59, 59)
    cases = [(start, 59, False), (start, 60, True), (start, 21600, True), (start, 21601, False), (start, -60, False)]
    cases += [(dt.datetime(2026, 2, 1), 600, False), (dt.datetime(2025, 12, 31, 23, 59), 600, False), (dt.datetime(2026, 1, 1), 600, True)]
    trips = [tuple({**row, "l_orderkey": i, C.pickup: t, C.dropoff: t + dt.timedelta(seconds=s)}.values()) for i, (t, s, _) in enumerate(cases)]
    df = spark.createDataFrame(trips, schema)
    kept = {r["l_orderkey"] for r in clean(df, specs.cleaning_steps(df)).collect()}
    assert kept == {i for i, (_, _, keep) in enumerate(cases) if keep}


def test_every_rule_decides_rows_of_the_fixture(spark):
    trips = load_trips(spark, SF_SMALL).distinct()
    rules = [r for s in specs.cleaning_steps(trips) for r in s.rules]
    fails = [F.when(F.coalesce(r.keep, F.lit(False)), 0).otherwise(1) for r in rules]
    alone = [F.sum(F.when((sum(fails) == 1) & (f == 1), 1).otherwise(0)).alias(str(i)) for i, f in enumerate(fails)]
    counts = dict(zip((r.name for r in rules), trips.agg(*alone).first()))
    # a row that ends before it begins is also too short; a missing value
    # fails the comparisons on its column too
    implied = {"dropoff > pickup"}
    both = {f"required {c}" for c in specs.critical_columns()}
    assert {k for k, v in counts.items() if not v} <= implied | both
    for column in specs.critical_columns():
        assert trips.filter(F.col(column).isNull()).count() > 0, column


def test_revenue_by_hour_and_vendor(spark):
    rows = [(5, 2, 2, 0.1), (5, 1, 1, 0.2), (23, 1, 6, 1e9), (23, 2, 1, 0.01)]
    df = spark.createDataFrame(rows, f"{C.hour} int, {C.vendor} int, {C.passengers} long, {C.total} double")
    rest = {c: F.lit(1.0) for c in (C.distance, C.fare, C.tip, C.tip_pct, C.duration_min, C.speed)}
    df = df.withColumns(rest)
    by_hour = {r[C.hour]: r for r in summarise(df, specs.gold_specs()["by_hour"]).collect()}
    assert {h: (r["total_trips"], r["total_passengers"], r["total_revenue"]) for h, r in by_hour.items()} == {
        5: (2, 3, 0.3), 23: (2, 7, 1000000000.01)
    }
    by_vendor = {r["vendor_name"]: r["total_revenue"] for r in summarise(df, specs.gold_specs()["by_vendor"]).collect()}
    assert by_vendor == {"Creative Mobile": 1000000000.2, "VeriFone": 0.11}


@pytest.mark.parametrize("partitions", [1, 3, 7, 16])
def test_sums_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(300_000).selectExpr("1 as g", "(id * 7919 % 1000003) * 100.01D + id / 7D as x").repartition(partitions)
    from tripflow.operators.summarise import Measure, Summary

    got = summarise(df, Summary("s", ("g",), (Measure("x", "sum", "x", 2),))).first()["x"]
    one = summarise(df.coalesce(1), Summary("s", ("g",), (Measure("x", "sum", "x", 2),))).first()["x"]
    assert got == one and got > 1e13
    odd = df.limit(5).selectExpr("1 as g", "double('NaN') as x")
    assert str(summarise(odd, Summary("s", ("g",), (Measure("x", "sum", "x", 2),))).first()["x"]) == "nan"


def test_one_far_value_per_column_goes(spark):
    rows = [(float(10 + i % 5), float(30 + i % 7), float(40 + i % 3)) for i in range(40)]
    rows += [(900.0, 31.0, 41.0), (11.0, -500.0, 41.0), (11.0, 31.0, 7000.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = iqr_filter(df, ["a", "b", "c"], 1.5)
    assert out.count() == 40 and out.agg(F.max("a"), F.min("b"), F.max("c")).first() == (14.0, 30.0, 42.0)


def test_infinite_and_nan_values_in_bounds(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, inf, inf)], "x double")
    kept, bounds = iqr_filter_with_bounds(df, ["x"], 1.5)
    assert bounds[0].q1 == 1.0 and bounds[0].q3 == inf and kept.count() == 4
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, nan)], "x double")
    kept, bounds = iqr_filter_with_bounds(df, ["x"], 1.5)
    assert (bounds[0].q1, bounds[0].q3) == (1.0, 3.0) and kept.count() == 3


def test_large_integers_and_decimals_keep_their_value(spark):
    from decimal import Decimal

    from tripflow.operators.quantile_select import QuantileTarget, exact_quantiles

    big = 9007199254740993
    df = spark.createDataFrame([(big + i, Decimal(f"{i}.{i:02d}")) for i in range(9)], "n long, d decimal(10,2)")
    got = exact_quantiles(df, [QuantileTarget("n", "n", 0.5), QuantileTarget("d", "d", 0.75)], accuracy=2)
    assert got["n"] == big + 4 and got["d"] == Decimal("6.06")


def candidates(spark, pairs):
    return spark.createDataFrame([(i, m, r) for i, (m, r) in enumerate(pairs)], "position int, multiplier double, retain_ratio double")


@pytest.mark.parametrize(
    "pairs, threshold, want",
    [
        ([(2.5, 0.99), (0.5, 0.9), (1.0, 0.95)], 0.9, 0.5),  # the smallest that reaches it, wherever it stands
        ([(0.5, 0.4), (1.0, 0.6), (4.0, 0.6)], 0.9, 1.0),  # none does: the highest ratio, the first of equals
        ([(3.0, 0.0)], 0.5, 3.0),
    ],
)
def test_choice_of_multiplier(spark, pairs, threshold, want):
    assert choose_multiplier(candidates(spark, pairs), threshold) == want
