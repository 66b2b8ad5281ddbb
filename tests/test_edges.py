"""Edge inputs: empty frames, nulls, NaN, zero divisors, inclusive bounds,
ties at a top-k cut, a single-valued histogram, unmapped codes."""

import datetime as dt
import pytest
from pyspark.sql import functions as F

from tripflow.functions.features import add_features
from tripflow.operators import profile as P
from tripflow.operators.outliers import choose_multiplier, iqr_candidates, iqr_filter
from tripflow.operators.report import layer_report
from tripflow.operators.rules import clean, funnel, quarantine
from tripflow.operators.summarise import top_k
from tripflow.plans import specs
from tripflow.plans.report_job import payment_share

SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, fare_amount double, tip_amount double, "
    "total_amount double, payment_type bigint, PULocationID int, DOLocationID int"
)
T0 = dt.datetime(2026, 1, 10, 8, 0, 0)


def trip(secs=600, vendor=1, pax=1, dist=2.0, fare=10.0, tip=1.0, total=12.0, pay=1, start=T0):
    return (vendor, start, start + dt.timedelta(seconds=secs), pax, dist, fare, tip, total, pay, 1, 2)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def kept(spark, rows):
    df = frame(spark, rows)
    return clean(df, specs.cleaning_steps(df)).count()


def test_empty_frame_everywhere(spark):
    df = frame(spark, [])
    steps = specs.cleaning_steps(df)
    f = {r["name"]: (r["rows_in"], r["rows_out"]) for r in funnel(df, steps).collect()}
    assert f["read"] == (0, 0) and f["time"] == (0, 0)
    tuning = iqr_candidates(df, specs.iqr_columns(), [1.5, 3.0])
    rows = tuning.table.collect()
    assert [r["retain_ratio"] for r in rows] == [0.0, 0.0]
    assert choose_multiplier(tuning.table, 0.9) == 1.5
    assert P.duplicate_stats(df).first()["duplicate_pct"] == 0.0
    assert [r["value"] for r in P.quantiles(df, ["fare_amount"], [0.5]).collect()] == [None]
    h = P.histogram(df, "fare_amount", 0, 100, 4).collect()
    assert len(h) == 4 and sum(r["count"] for r in h) == 0
    rep = layer_report(df, df).first()
    assert rep["original_rows"] == 0 and rep["removed_pct"] is None


def test_inclusive_bounds_kept(spark):
    rows = [
        trip(secs=60),
        trip(secs=21600),
        trip(fare=2.5),
        trip(fare=500.0),
        trip(dist=200.0),
        trip(total=1000.0),
        trip(pax=1),
        trip(pax=6),
        trip(start=dt.datetime(2026, 1, 31, 23, 59, 59, 999999), secs=600),
        trip(start=dt.datetime(2026, 1, 1, 0, 0, 0), secs=600),
    ]
    assert kept(spark, rows) == len(rows)


def test_just_outside_bounds_dropped(spark):
    rows = [
        trip(secs=59),
        trip(secs=21601),
        trip(fare=2.49),
        trip(dist=0.0),
        trip(total=1000.01),
        trip(pax=0),
        trip(pax=7),
        trip(vendor=6),
        trip(tip=-0.01),
        trip(tip=None),
        trip(start=dt.datetime(2025, 12, 31, 23, 59, 59), secs=600),
        trip(start=dt.datetime(2026, 2, 1, 0, 0, 0), secs=600),
        trip(secs=0),
        trip(secs=-5),
    ]
    assert kept(spark, rows) == 0


def test_nan_is_dropped_as_missing_and_counted_apart(spark):
    df = frame(spark, [trip(dist=float("nan")), trip()])
    assert clean(df, specs.cleaning_steps(df)).count() == 1
    nulls = {r["column"]: (r["nulls"], r["nans"]) for r in P.null_counts(df).collect()}
    assert nulls["trip_distance"] == (0, 1)


def test_all_null_column(spark):
    df = frame(spark, [trip(pay=None), trip(pay=None, dist=3.0)])
    nulls = {r["column"]: r["nulls"] for r in P.null_counts(df).collect()}
    assert nulls["payment_type"] == 2
    assert [r["value"] for r in P.quantiles(df, ["payment_type"], [0.5]).collect()] == [None]
    # payment_type is not critical: both rows survive cleaning
    assert clean(df, specs.cleaning_steps(df)).count() == 2


def test_zero_fare_and_zero_duration_give_null_not_error(spark):
    df = frame(spark, [trip(fare=0.0, secs=0)])
    r = add_features(df).first()
    assert r["tip_percentage"] is None and r["speed_mph"] is None and r["trip_duration_min"] == 0.0


def test_fractional_seconds_truncate_each_side(spark):
    start = dt.datetime(2026, 1, 5, 10, 0, 0, 900000)
    df = frame(spark, [(1, start, dt.datetime(2026, 1, 5, 10, 1, 0, 100000), 1, 1.0, 5.0, 0.0, 6.0, 1, 1, 1)])
    assert add_features(df).first()["trip_duration_min"] == 1.0  # 60 whole seconds


def test_funnel_counts_duplicates_and_steps(spark):
    rows = [trip(), trip(), trip(), trip(vendor=6), trip(pax=None), trip(secs=30)]
    df = frame(spark, rows)
    steps = specs.cleaning_steps(df)
    f = {r["name"]: r["removed"] for r in funnel(df, steps).collect()}
    assert f == {"read": 0, "dedupe": 2, "required": 1, "range": 1, "time": 1}
    rej = quarantine(df, steps).groupBy("reject_step").agg(F.sum("copies").alias("n"))
    assert {r["reject_step"]: r["n"] for r in rej.collect()} == {"dedupe": 2, "required": 1, "range": 1, "time": 1}


def test_top_k_tie_at_cut_is_deterministic(spark):
    df = spark.createDataFrame([(3, 10), (1, 10), (2, 10), (4, 5)], "loc int, total_trips bigint")
    got = [r["loc"] for r in top_k(df, [("total_trips", False)], 2, keys=["loc"]).collect()]
    assert got == [1, 2]


def test_histogram_single_value(spark):
    df = spark.createDataFrame([(7.0,), (7.0,)], "fare_amount double")
    h = P.histogram(df, "fare_amount", 0, 100, 10).collect()
    assert h[0]["bin_lo"] == 6.5 and h[-1]["bin_hi"] == 7.5
    assert sum(r["count"] for r in h) == 2


def test_histogram_matches_numpy(spark):
    np = pytest.importorskip("numpy")
    vals = [0.0, 0.3, 1.7, 2.0, 2.5, 3.3, 9.99, 10.0, 4.2, 4.2, 7.1]
    df = spark.createDataFrame([(v,) for v in vals], "fare_amount double")
    h = P.histogram(df, "fare_amount", 0, 100, 7).collect()
    counts, edges = np.histogram(np.array(vals), bins=7)
    assert [r["count"] for r in h] == list(counts)
    assert [r["bin_lo"] for r in h] == list(edges[:-1])


def test_unmapped_and_null_payment_labels(spark):
    gold = spark.createDataFrame([(1, 5), (9, 3), (None, 2)], "payment_type bigint, total_trips bigint")
    got = {r["payment_type"]: (r["display_name"], r["share_pct"]) for r in payment_share(gold).collect()}
    assert got[1] == ("Credit Card", 50.0) and got[9] == ("9", 30.0) and got[None] == (None, 20.0)


def test_iqr_no_values_keeps_rows(spark):
    df = spark.createDataFrame([(None,), (None,)], "trip_distance double")
    assert iqr_filter(df, ["trip_distance"], 1.5).count() == 2


def test_month_rule_pushes_as_range(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [trip()]).write.parquet(path)
    df = spark.read.parquet(path)
    from conftest import plan_text

    plan = plan_text(clean(df, specs.cleaning_steps(df)))
    pushed = plan.split("PushedFilters:")[1].split("\n")[0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2026-01-01T00:00)" in pushed
    assert "LessThan(tpep_pickup_datetime,2026-02-01T00:00)" in pushed


def test_local_frame_round_trips_every_rendered_type(spark):
    import decimal
    import math

    from pyspark.sql import types as T

    from tripflow.sources.io import local_frame

    schema = T.StructType(
        [
            T.StructField("i", T.IntegerType()),
            T.StructField("l", T.LongType()),
            T.StructField("d", T.DoubleType()),
            T.StructField("s", T.StringType()),
            T.StructField("b", T.BooleanType()),
            T.StructField("dt", T.DateType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("dec", T.DecimalType(12, 3)),
        ]
    )
    rows = [
        (1, 2**40, 0.1, "it's a \\ 'quote'", True, dt.date(2026, 1, 31), dt.datetime(2026, 1, 1, 0, 0, 0, 123456), decimal.Decimal("12.345")),
        (None, None, float("nan"), "ünïcode", False, None, None, None),
        (-7, -(2**62), float("-inf"), "", None, dt.date(1999, 12, 31), dt.datetime(2025, 12, 30, 23, 59, 59), decimal.Decimal("-0.001")),
        (0, 0, 5e-324, None, True, None, None, decimal.Decimal("0")),
    ]
    df = local_frame(spark, rows, schema)
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in schema.fields]
    got = [tuple(r) for r in df.collect()]
    for g, w in zip(got, rows):
        for a, b in zip(g, w):
            if isinstance(b, float) and math.isnan(b):
                assert math.isnan(a)
            else:
                assert a == b, (a, b)
    # a VALUES table is a local relation: reading it launches no job
    sc = spark.sparkContext
    sc.setJobGroup("local-frame", "local-frame")
    try:
        df.filter("i IS NOT NULL").collect()
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(key, None)
    assert sc.statusTracker().getJobIdsForGroup("local-frame") == []
