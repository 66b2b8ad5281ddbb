"""Every operator as a named query over the test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame.  They
all start from the ``trips`` fixture derived from the whole ``lineitem``
table, so their work grows with the table.  The silver build (one dedupe
shuffle, staged to the scratch folder, tuned) and the gold tables (one
pass over silver) are shared by the queries of one session over the same
files and settings, as a pipeline shares its layers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.columns import TRIP as C
from tripflow.functions.features import add_features
from tripflow.operators import outliers as O
from tripflow.operators import profile as P
from tripflow.operators.report import layer_report
from tripflow.operators.rules import clean
from tripflow.operators.heavy import top_groups
from tripflow.operators.sketches import merged_quantiles, quantile_sketches, within_bound
from tripflow.operators.summarise import summarise
from tripflow.plans import report_job as R
from tripflow.plans import specs
from tripflow.plans.gold import build_gold
from tripflow.plans.profile_job import out_of_month_rows
from tripflow.plans.silver import SilverBuild, build_silver
from tripflow.session import scratch_path
from tripflow.sources.fixture import LINEITEM_COLUMNS, trips_from_lineitem
from tripflow.sources.io import land, read_layer, write_layer
from tripflow.streaming.landing import land_incrementally

Query = Callable[[SparkSession, str], DataFrame]

ALL_MULTIPLIERS = (0.05, 0.1, 0.25, 0.5, 1.5, 2.0, 2.5, 3.0)
FALLBACK_THRESHOLD = 0.995  # above every candidate's retain ratio on the fixture

_silver_builds: dict[tuple, SilverBuild] = {}
_gold_builds: dict[tuple, dict[str, DataFrame]] = {}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_layer(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    missing = [c for c in LINEITEM_COLUMNS if c not in lineitem.columns]
    if missing:
        raise ValueError(f"lineitem lacks {missing}")
    return specs.check_trips(trips_from_lineitem(lineitem))


def trips_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with NaN and infinite distances among them."""
    odd = F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).when(
        F.col("l_orderkey") % 7 == 1, F.lit(float("inf"))
    )
    return trips(spark, sf_dir).withColumn(C.distance, odd.otherwise(F.col(C.distance)))


def _build_key(spark: SparkSession, sf_dir: str) -> tuple:
    """What the silver build depends on: the input files as they are now,
    and the retain ratio."""
    files = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(
        F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("f")
    )
    state = files.groupBy().agg(F.count("*"), F.sum(F.col("f").cast("decimal(38,0)"))).first()
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), specs.min_retain_ratio(), *state)


def silver_build(spark: SparkSession, sf_dir: str) -> SilverBuild:
    key = _build_key(spark, sf_dir)
    if key not in _silver_builds:
        target = scratch_path(spark, "silver")
        _silver_builds[key] = build_silver(trips(spark, sf_dir), target=target)
    return _silver_builds[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_build(spark, sf_dir).silver


def time_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduped rows passing required, range and time rules (pre-outlier)."""
    t = trips(spark, sf_dir)
    return clean(t, specs.cleaning_steps(t))


def _clean_upto(k: int, month: int = specs.TARGET_MONTH) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = trips(spark, sf_dir)
        return clean(t, specs.cleaning_steps(t, month=month)[:k])

    return q


def staged_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass every step before outlier removal, as the silver
    build staged them: the outlier queries share its dedupe shuffle."""
    return silver_build(spark, sf_dir).passing


def _gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _build_key(spark, sf_dir)
    if key not in _gold_builds:
        _gold_builds[key] = build_gold(silver(spark, sf_dir))
    return _gold_builds[key]


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: _gold_tables(spark, sf_dir)[name]


def _gold_single(name: str) -> Query:
    """The one-aggregate-per-table form of a gold table."""
    return lambda spark, sf_dir: summarise(silver(spark, sf_dir), specs.gold_specs()[name])


_LAND_COLUMNS = ("status", "rows_read", "rows_written", "columns", "same_schema", "same_content")
PREVIEW_ROWS = 5


def _heavy(name: str) -> Query:
    """A top-k gold table from the candidates of a bounded sketch."""
    return lambda spark, sf_dir: top_groups(silver(spark, sf_dir), specs.gold_specs()[name], "total_trips")


def _sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles merged from sketches by day, held against exact ranks."""
    rows = silver(spark, sf_dir)
    days = quantile_sketches(rows, (C.date,), specs.range_columns())
    return within_bound(rows, merged_quantiles(days, specs.range_columns(), specs.QUANTILE_PROBS))


def _land_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = land(spark, trips(spark, sf_dir), scratch_path(spark, "bronze"), if_exists="replace", verify="content")
    return report.select(*_LAND_COLUMNS)


def _land_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing twice: the second run finds the committed target."""
    target = scratch_path(spark, "bronze")
    land(spark, trips(spark, sf_dir), target)
    return land(spark, trips(spark, sf_dir), target).select(*_LAND_COLUMNS)


def _land_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample rows that landing reports."""
    source = trips(spark, sf_dir)
    report = land(spark, source, scratch_path(spark, "bronze"), sample_rows=PREVIEW_ROWS)
    rows = report.select(F.explode("sample").alias("j")).select(F.from_json("j", source.schema).alias("r"))
    return rows.select("r.*")


def _land_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files landed by the incremental (streaming) path, read back."""
    raw = scratch_path(spark, "raw")
    trips(spark, sf_dir).write.parquet(raw)
    target = scratch_path(spark, "bronze-stream")
    land_incrementally(spark, raw, target, scratch_path(spark, "bronze-stream-ckpt"))
    return spark.read.parquet(target)


def _silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver-copy")
    write_layer(silver(spark, sf_dir), path)
    return read_layer(spark, path)


def _iqr_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_passing(spark, sf_dir)
    return O.bounds_table(spark, O.iqr_bounds(rows, specs.iqr_columns(), 3.0))


def _iqr_bounds_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips_with_nan(spark, sf_dir)
    return O.bounds_table(spark, O.iqr_bounds(rows, (C.distance,), 1.5))


def _iqr_filter(columns, m: float, mode: str = "sequential") -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return O.iqr_filter(staged_passing(spark, sf_dir), columns, m, mode)

    return q


def _iqr_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.iqr_candidates(staged_passing(spark, sf_dir), specs.iqr_columns(), ALL_MULTIPLIERS).table


def _iqr_pick(threshold: float | None = None) -> Query:
    return lambda spark, sf_dir: O.pick_multiplier(
        silver_build(spark, sf_dir).candidates, specs.min_retain_ratio() if threshold is None else threshold
    )


def _clean_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select(*trips(spark, sf_dir).columns)


def _profile(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(trips(spark, sf_dir))


def _given(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    """A profile operator over another given table (column names are
    parameters, not the trip schema)."""
    return lambda spark, sf_dir: fn(read_layer(spark, f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _report(fn: Callable[[dict[str, DataFrame]], DataFrame], *tables: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = _gold_tables(spark, sf_dir)
        return fn({t: gold[t] for t in tables})

    return q


def registry() -> dict[str, Query]:
    lo, hi, bins = specs.FARE_HISTOGRAM
    q: dict[str, Query] = {
        # sources / sinks
        "scan_trips": trips,
        "land_report": _land_report,
        "land_preview": _land_preview,
        "land_stream": _land_stream,
        "land_skip": _land_skip,
        # bounded sketches
        "sketch_quantiles": _sketch_quantiles,
        "heavy_pickups": _heavy("by_pickup_location_top20"),
        "heavy_routes": _heavy("by_route_top50"),
        # profile
        "profile_shape": _profile(P.shape),
        "profile_describe": _profile(lambda df: P.describe_numeric(df, specs.describe_columns(), 6)),
        "profile_nulls": _profile(P.null_counts),
        "profile_duplicates": _profile(P.duplicate_stats),
        "profile_by_date": _profile(lambda df: P.count_by(df, F.to_date(C.pickup), C.date)),
        "profile_by_hour": _profile(lambda df: P.count_by(df, F.hour(C.pickup), C.hour)),
        "profile_vendor_dist": _profile(lambda df: P.distribution(df, C.vendor)),
        "profile_payment_dist": _profile(lambda df: P.distribution(df, C.payment)),
        "profile_ranges": _profile(lambda df: P.value_ranges(df, specs.range_columns(), 6)),
        "profile_quantiles": _profile(
            lambda df: P.quantiles(df, specs.quantile_columns(), specs.QUANTILE_PROBS)
        ),
        "profile_quantiles_nan": lambda spark, sf_dir: P.quantiles(
            trips_with_nan(spark, sf_dir), (C.distance,), specs.QUANTILE_PROBS
        ),
        "profile_out_of_month": _profile(out_of_month_rows),
        "profile_issues": _profile(lambda df: P.issues(df, specs.profile_checks())),
        "profile_fare_histogram": _profile(lambda df: P.histogram(df, C.fare, lo, hi, bins)),
        # the same profile operators on other given tables
        "profile_orders_quantiles": _given("orders", lambda df: P.quantiles(df, ["o_totalprice"], specs.QUANTILE_PROBS)),
        "profile_orders_describe": _given("orders", lambda df: P.describe_numeric(df, ["o_totalprice"], 6)),
        "profile_events_nulls": _given("events", P.null_counts),
        # cleaning
        "clean_dedupe": _clean_upto(0),
        "clean_required": _clean_upto(1),
        "clean_rules": _clean_upto(2),
        "clean_time_window": _clean_upto(3),
        "clean_time_window_feb": _clean_upto(3, month=2),
        "clean_funnel": lambda spark, sf_dir: silver_build(spark, sf_dir).funnel(),
        "clean_rejects": lambda spark, sf_dir: silver_build(spark, sf_dir).rejects(),
        # outliers
        "iqr_bounds": _iqr_bounds,
        "iqr_bounds_nan": _iqr_bounds_nan,
        "iqr_filter_one": _iqr_filter((C.distance,), 1.5),
        "iqr_filter_all": _iqr_filter(specs.iqr_columns(), 0.25),
        "iqr_filter_independent": _iqr_filter(specs.iqr_columns(), 0.25, "independent"),
        "iqr_candidates": _iqr_candidates,
        "iqr_pick": _iqr_pick(),
        "iqr_pick_fallback": _iqr_pick(FALLBACK_THRESHOLD),
        "clean_outliers": _clean_outliers,
        # features and silver
        "features": lambda spark, sf_dir: add_features(time_clean(spark, sf_dir)),
        "silver": silver,
        "silver_roundtrip": _silver_roundtrip,
        # gold
        "gold_by_hour": _gold("by_hour"),
        "gold_by_dayofweek": _gold("by_dayofweek"),
        "gold_by_date": _gold("by_date"),
        "gold_by_dow_hour": _gold("by_dow_hour"),
        "gold_by_vendor": _gold("by_vendor"),
        "gold_by_payment": _gold("by_payment"),
        "gold_by_date_single": _gold_single("by_date"),
        "gold_top_pickups": _gold("by_pickup_location_top20"),
        "gold_top_routes": _gold("by_route_top50"),
        "silver_summary": lambda spark, sf_dir: summarise(silver(spark, sf_dir), specs.silver_summary_spec()),
        # reports
        "report_layers": lambda spark, sf_dir: layer_report(trips(spark, sf_dir), silver(spark, sf_dir)),
        "report_vendor": _report(lambda g: R.vendor_comparison(g["by_vendor"]), "by_vendor"),
        "report_payment": _report(lambda g: R.payment_ranking(g["by_payment"]), "by_payment"),
        "report_top_hours": _report(lambda g: R.top_hours(g["by_hour"]), "by_hour"),
        "report_first_dates": _report(lambda g: R.first_dates(g["by_date"]), "by_date"),
        "busy_hours_top10": lambda spark, sf_dir: R.busy_hours(silver(spark, sf_dir)),
        "heatmap_matrix": _report(lambda g: R.hour_weekday_matrix(g["by_dow_hour"]), "by_dow_hour"),
        "payment_share": _report(lambda g: R.payment_share(g["by_payment"]), "by_payment"),
    }
    return q
