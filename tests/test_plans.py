"""Plan shape and job-level behaviour: pushdown, pruning, one-pass gold,
landing, layouts, schema checks."""

import pytest

from tripflow.operators.summarise import summarise
from tripflow.plans import specs
from tripflow.plans.gold import build_gold
from tripflow.plans.silver import build_silver
from tripflow.sources.fixture import load_trips
from tripflow.sources.io import SchemaError, check_schema, land, read_layer, write_layer
from tripflow.sources.layout import Layout

from conftest import SF_SMALL, plan_text


def plan_of(df):
    return plan_text(df)


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "trips")
    write_layer(load_trips(spark, SF_SMALL), path)
    return read_layer(spark, path)


@pytest.fixture(scope="module")
def built(bronze, tmp_path_factory):
    return build_silver(bronze, target=str(tmp_path_factory.mktemp("silver") / "s"))


def test_rules_reach_parquet_through_dedupe(bronze):
    from tripflow.operators.rules import clean

    plan = plan_of(clean(bronze, specs.cleaning_steps(bronze)))
    pushed = plan.split("PushedFilters:")[1].split("\n")[0]
    assert "IsNotNull(tpep_pickup_datetime)" in pushed
    assert "GreaterThan(trip_distance,0.0)" in pushed and "In(VendorID, [1,2])" in pushed


def test_gold_reads_only_needed_columns(built):
    plan = plan_of(summarise(built.silver, specs.gold_specs()["by_vendor"]))
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "l_orderkey" not in schema and "VendorID" in schema


def test_one_pass_gold_equals_per_table(built):
    one = build_gold(built.silver)
    each = build_gold(built.silver, one_pass=False)
    for name in specs.gold_specs():
        a = sorted(map(tuple, one[name].collect()), key=repr)
        b = sorted(map(tuple, each[name].collect()), key=repr)
        assert a == b, name
        assert one[name].columns == each[name].columns


def test_funnel_and_rejects_agree(built):
    f = {r["name"]: r["removed"] for r in built.funnel().collect()}
    rej = built.rejects().groupBy("reject_step").sum("copies").collect()
    assert {r[0]: r[1] for r in rej} == {k: v for k, v in f.items() if v and k != "read"}
    last = built.funnel().orderBy("step").collect()[-1]
    assert last["rows_out"] == built.silver.count()


def test_land_skip_and_replace(spark, tmp_path):
    src = load_trips(spark, SF_SMALL)
    target = str(tmp_path / "bronze")
    first = land(spark, src, target).first()
    assert first["status"] == "landed" and first["rows_read"] == first["rows_written"]
    again = land(spark, src, target).first()
    assert again["status"] == "skipped" and again["rows_written"] == first["rows_written"]
    replaced = land(spark, src, target, if_exists="replace").first()
    assert replaced["status"] == "landed"


def test_layout_paths():
    lay = Layout("hdfs://nn:9000/lake", "2026_01")
    assert lay.bronze == "hdfs://nn:9000/lake/bronze/raw/2026_01"
    assert lay.gold("by_hour").endswith("gold/aggregated_by_time/2026_01/by_hour")
    assert lay.gold("by_route_top50").endswith("gold/aggregated_by_vendor/2026_01/by_route_top50")
    with pytest.raises(KeyError):
        lay.gold("nope")


def test_schema_check_lists_problems(spark, bronze):
    from pyspark.sql import types as T

    with pytest.raises(SchemaError, match="missing column 'nope'.*fare_amount"):
        check_schema(bronze, {"nope": (T.DoubleType,), "fare_amount": (T.StringType,)})
    assert read_layer(spark, bronze.inputFiles()[0].rsplit("/", 1)[0], {"fare_amount": (T.DoubleType,)})


def test_profile_job_equals_single_operators(spark, bronze):
    from pyspark.sql import functions as F

    from tripflow.columns import TRIP as C
    from tripflow.operators import profile as P
    from tripflow.plans.profile_job import out_of_month_rows, profile

    got = profile(bronze)
    lo, hi, bins = specs.FARE_HISTOGRAM
    want = {
        "shape": P.shape(bronze),
        "describe": P.describe_numeric(bronze, specs.describe_columns(), 6),
        "nulls": P.null_counts(bronze),
        "duplicates": P.duplicate_stats(bronze),
        "by_date": P.count_by(bronze, F.to_date(C.pickup), C.date),
        "by_hour": P.count_by(bronze, F.hour(C.pickup), C.hour),
        "vendor_dist": P.distribution(bronze, C.vendor),
        "payment_dist": P.distribution(bronze, C.payment),
        "ranges": P.value_ranges(bronze, specs.range_columns(), 6),
        "out_of_month": out_of_month_rows(bronze),
        "issues": P.issues(bronze, specs.profile_checks()),
        "fare_histogram": P.histogram(bronze, C.fare, lo, hi, bins),
    }
    for name, frame in want.items():
        assert got[name].columns == frame.columns, name
        assert sorted(map(tuple, got[name].collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr), name


def test_duplicates_from_staged_copies_equal_the_shuffle(built, bronze):
    from tripflow.operators.profile import duplicate_stats

    staged = built.duplicate_stats().collect()
    assert staged == duplicate_stats(bronze).collect()
    assert staged[0]["duplicates"] > 0


def test_run_month_end_to_end(spark, tmp_path):
    from tripflow.plans.month import run_month

    lay = Layout(str(tmp_path / "lake"), "2026_01")
    first = run_month(spark, load_trips(spark, SF_SMALL), lay)
    assert first.landed.first()["status"] == "landed"
    funnel = {r["name"]: r["rows_out"] for r in read_layer(spark, f"{lay.reports}/funnel").collect()}
    # FIXTURES.md 2.1 at sf0.001: raw, dedupe, required, range, time
    assert [funnel[k] for k in ("read", "dedupe", "required", "range", "time")] == [6057, 6000, 5307, 4164, 3211]
    assert funnel["outliers"] == read_layer(spark, lay.silver).count()
    dups = read_layer(spark, f"{lay.reports}/profile_duplicates").first()
    assert (dups["rows"], dups["distinct_rows"]) == (6057, 6000)
    hours = read_layer(spark, lay.gold("by_hour"))
    assert hours.count() == 24 and hours.agg({"total_trips": "sum"}).first()[0] == funnel["outliers"]
    again = run_month(spark, load_trips(spark, SF_SMALL), lay)
    assert again.landed.first()["status"] == "skipped"


def test_library_has_no_python_udfs_rdds_or_local_checkpoints():
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parent.parent / "tripflow"
    banned = re.compile(r"\.rdd\b|\budf\b|pandas_udf|mapPartitions|localCheckpoint|toPandas|InPandas")
    hits = [f"{p.name}:{i}" for p in root.rglob("*.py") if "llm" not in p.parts for i, line in enumerate(p.read_text().splitlines(), 1) if banned.search(line)]
    assert hits == []


def test_bucket_round_pushes_window_and_aggregates_map_side(spark, bronze):
    import contextlib
    import io

    from pyspark.sql.classic.dataframe import DataFrame

    from tripflow.operators import quantile_select as Q

    t = Q.QuantileTarget("q", "fare_amount", 0.5)
    t.lo, t.hi, t.k = 10.0, 20.0, 1
    plans = []
    original = DataFrame.collect

    def capture(self):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            self.explain("formatted")
        plans.append(buf.getvalue())
        return original(self)

    DataFrame.collect = capture
    try:
        Q._bucket_round(bronze, [Q._Window("fare_amount", "CAST(`fare_amount` AS DOUBLE)", 10.0, 20.0, False, [t])], 16)
    finally:
        DataFrame.collect = original
    plan = plans[0]
    pushed = plan.split("PushedFilters:")[1].split("\n")[0]
    assert "GreaterThanOrEqual(fare_amount,10.0)" in pushed and "LessThanOrEqual(fare_amount,20.0)" in pushed
    assert "partial_count" in plan and "partial_min" in plan
    assert plan.split("ReadSchema:")[1].split("\n")[0].strip() == "struct<fare_amount:double>"
