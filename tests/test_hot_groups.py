"""Hot groups and awkward values: a third of all rows being copies of one
row or one value, NaN and infinities, several columns with filters.
Checked against brute force, plus the plan shape that keeps a hot group
off a single reducer (partial aggregation before every shuffle)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.operators.quantile_select import QuantileTarget, discrete_rank, exact_quantiles
from tripflow.operators.rules import funnel, tag_rows
from tripflow.plans import specs
from tripflow.sources.fixture import load_trips

from conftest import SF_SMALL, plan_text


def brute(values, p, keep=None):
    xs = sorted(v for i, v in enumerate(values) if v is not None and v == v and (keep is None or keep[i]))  # no NaN
    if not xs:
        return None
    return xs[discrete_rank(len(xs), p) - 1]


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b


def with_hot_copies(spark):
    """The trips fixture plus copies of one row: a third of all rows."""
    trips = load_trips(spark, SF_SMALL)
    n = trips.count()
    hot = trips.orderBy("l_orderkey", "l_linenumber").limit(1)
    copies = hot.withColumn("_c", F.explode(F.array_repeat(F.lit(1), n // 2))).drop("_c")
    return trips.unionByName(copies), n, n // 2


def test_hot_copy_group_funnel(spark):
    df, n, extra = with_hot_copies(spark)
    steps = specs.cleaning_steps(df)
    f = {r["name"]: (r["rows_in"], r["removed"]) for r in funnel(df, steps).collect()}
    plain = load_trips(spark, SF_SMALL)
    g = {r["name"]: (r["rows_in"], r["removed"]) for r in funnel(plain, specs.cleaning_steps(plain)).collect()}
    assert f["read"] == (n + extra, 0)
    # every added copy is a duplicate; later steps see the same distinct rows
    assert f["dedupe"] == (n + extra, g["dedupe"][1] + extra)
    for name in ("required", "range", "time"):
        assert f[name] == g[name]


def test_dedupe_aggregates_copies_before_the_shuffle(spark):
    df, _, _ = with_hot_copies(spark)
    plan = plan_text(tag_rows(df, specs.cleaning_steps(df)))
    tree = plan.split("\n\n")[0].split("\n")
    # the exchange on all columns has a (partial) hash aggregate as its
    # child, so copies collapse inside each map task
    at = next(i for i, line in enumerate(tree) if line.strip().startswith("+- Exchange"))
    assert "HashAggregate" in tree[at + 1]
    assert "Functions [1]: [partial_count(1)]" in plan
    assert "Arguments: hashpartitioning(l_orderkey" in plan


def test_quantile_of_hot_value(spark):
    values = [5.0] * 3000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    got = exact_quantiles(df, [QuantileTarget(p, "x", p) for p in probs], accuracy=64)
    assert got == {p: brute(values, p) for p in probs}


def test_quantiles_with_nan_and_infinities(spark):
    values = [1.0, 2.0, float("inf"), float("-inf"), float("nan"), float("nan"), None, 3.5, -2.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.1, 0.3, 0.5, 0.75, 0.8, 0.9, 1.0):
        got = exact_quantiles(df, [QuantileTarget("q", "x", p)], accuracy=4)["q"]
        assert same(got, brute(values, p)), p


SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.floats(-1e6, 1e6)),
            st.one_of(st.none(), st.integers(-20, 20).map(float)),
            st.integers(0, 3),
        ),
        max_size=80,
    ),
    st.sampled_from([2, 8, 512]),
)
def test_many_columns_and_filters_equal_brute_force(spark, rows, buckets):
    df = spark.createDataFrame(rows, "a double, b double, g int")
    gs = [r[2] for r in rows]
    targets, want = [], {}
    for col, idx in (("a", 0), ("b", 1)):
        values = [r[idx] for r in rows]
        for p in (0.0, 0.25, 0.5, 0.9, 1.0):
            targets.append(QuantileTarget((col, None, p), col, p))
            want[(col, None, p)] = brute(values, p)
            for g in (0, 2):
                targets.append(QuantileTarget((col, g, p), col, p, F.col("g") <= g))
                want[(col, g, p)] = brute(values, p, [x <= g for x in gs])
    got = exact_quantiles(df, targets, accuracy=buckets)
    assert all(same(got[k], want[k]) for k in want), {k: (got[k], want[k]) for k in want if not same(got[k], want[k])}


def test_quantiles_of_extreme_and_subnormal_values(spark):
    values = [5e-324, 1e-323, 1.5e-323, 0.0, -5e-324, 1e308, -1e308, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.2, 0.4, 0.5, 0.6, 0.8, 1.0):
        got = exact_quantiles(df, [QuantileTarget("q", "x", p)], accuracy=2)["q"]
        assert got == brute(values, p), p
