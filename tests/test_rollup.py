"""Roll-ups: merged states equal one aggregate over all rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tripflow.columns import TRIP as C
from tripflow.operators.rollup import RollUp, derive, merge, partials
from tripflow.operators.summarise import Measure, Summary, summarise
from tripflow.plans import specs
from tripflow.plans.gold import build_gold, refresh_gold
from tripflow.plans.silver import build_silver
from tripflow.sources.fixture import load_trips
from tripflow.sources.layout import Layout

from conftest import SF_SMALL, plan_text


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "silver")
    return build_silver(load_trips(spark, SF_SMALL), target=path).silver


def rows_of(tables):
    return {name: [tuple(r) for r in df.collect()] for name, df in tables.items()}


def test_tables_from_rollups_equal_one_aggregate_each(silver):
    derived, single = build_gold(silver), build_gold(silver, one_pass=False)
    assert rows_of(derived) == rows_of(single)
    for name in derived:
        assert derived[name].dtypes == single[name].dtypes, name


def test_day_by_day_refresh_equals_one_pass(spark, silver, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    days = [r[0] for r in silver.select(C.date).distinct().orderBy(F.rand(3)).collect()]
    refresh_gold(silver.where(F.col(C.date).isin(days[:20])), layout)
    partial = silver.where(F.col(C.date) == days[20]).limit(3)
    refresh_gold(partial, layout)  # a day that comes in part first
    for day in days[20:-1]:
        refresh_gold(silver.where(F.col(C.date) == day), layout)
    tables = refresh_gold(silver.where(F.col(C.date) == days[-1]), layout)
    assert rows_of(tables) == rows_of(build_gold(silver))
    fewer = silver.where(F.col(C.date).isin(days[:3]))
    assert rows_of(refresh_gold(fewer, layout, whole=True)) == rows_of(build_gold(fewer))


MEASURES = (
    Measure("n", "count"), Measure("s", "sum", "x", 2), Measure("full", "sum", "x"), Measure("a", "avg", "x", 2),
    Measure("k", "sum", "i"), Measure("ka", "avg", "i", 2), Measure("d", "sum", "d", 1), Measure("lo", "min", "x"), Measure("hi", "max", "x"),
)
SPEC = Summary("s", ("g",), MEASURES, order=(("g", True),))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_merging_in_any_order_gives_the_same_sums(spark, parts):
    rng = random.Random(parts)
    rows = [(i % 3 or None, i % 7, rng.choice([rng.randrange(10**7) / 100, rng.random() * 1e4, -0.1, None]), rng.randrange(99))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, day int, x double, i int").withColumn("d", F.expr("cast(i as decimal(6,2)) / 4"))
    rollup = RollUp.serving("r", ("day", "g"), [SPEC])
    split = [partials(df.where(F.col("day") == d).repartition(parts), rollup) for d in (4, 1, 6, 0, 2, 5, 3)]
    states = split[0]
    for more in split[1:]:
        states = states.unionAll(more)
    halves = merge(states.where("day < 3"), ("g",)).unionAll(merge(states.where("day >= 3"), ("g",)))
    want = [tuple(r) for r in summarise(df.coalesce(1), SPEC).collect()]
    for got in (derive(states, SPEC), derive(halves, SPEC)):
        for a, b in zip(got.collect(), want, strict=True):
            for name, x, y in zip(SPEC.keys + tuple(m.name for m in MEASURES), a, b, strict=True):
                assert x == y or (name == "full" and math.isclose(x, y, rel_tol=1e-12)), name


def test_sums_of_odd_and_far_values(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [("inf", inf), ("inf", 1.0), ("nan", nan), ("nan", 2.0), ("far", 5e15), ("far", 0.5), ("null", None), ("both", inf), ("both", -inf)],
        "g string, x double",
    )
    spec = Summary("s", ("g",), (Measure("s", "sum", "x", 2), Measure("a", "avg", "x", 2)))
    got = {r["g"]: (r["s"], r["a"]) for r in derive(partials(df, RollUp.serving("r", ("g",), [spec])), spec).collect()}
    assert got["inf"][0] == inf and math.isnan(got["nan"][0]) and math.isnan(got["both"][0])
    assert got["far"][0] == 5e15 + 0.5 and got["null"] == (None, None)


def test_rows_beyond_a_bigint_of_remainders_still_merge(spark):
    """States as of 9e12 rows of 0.00009 in two groups."""
    n = 9 * 10**12
    states = spark.createDataFrame([(1, n, n, 0, 90000 * n, None)] * 2, "g int, _rows long, _sum_n_x long, _sum_units_x long, _sum_rest_x long, _sum_far_x double")
    got = derive(states, Summary("s", ("g",), (Measure("n", "count"), Measure("s", "sum", "x", 2)))).first()
    assert (got["n"], got["s"]) == (2 * n, 2 * n * 0.00009)


def test_rollup_reads_only_its_columns_and_aggregates_before_the_shuffle(silver):
    spec = specs.gold_specs()["by_route_top50"]
    plan = plan_text(partials(silver, RollUp.serving("r", (C.pickup_loc, C.dropoff_loc), [spec])))
    read = [x for x in plan.splitlines() if x.startswith("ReadSchema")]
    assert len(read) == 1 and read[0].count(":") == 1 + len({C.pickup_loc, C.dropoff_loc, C.distance, C.total, C.duration_min})
    assert plan.index("partial_sum") > 0 and plan.count("Exchange") >= 1


def test_a_summary_with_other_keys_is_refused(silver):
    with pytest.raises(ValueError, match="by_hour"):
        RollUp.serving("r", (C.vendor,), [specs.gold_specs()["by_hour"]])


def test_empty_silver_gives_empty_tables(silver):
    assert all(not rows for rows in rows_of(build_gold(silver.where("1 = 0"))).values())
