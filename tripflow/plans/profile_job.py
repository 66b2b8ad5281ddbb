"""The bronze quality profile as a set of DataFrames.

Shape, statistics, nulls, ranges and rule checks are single aggregates;
duplicates need one shuffle; the date / hour / vendor / payment
breakdowns are small group-bys.  Nothing pulls raw rows to the driver:
the fare histogram is binned in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.columns import TRIP, TripColumns
from tripflow.operators import profile as P
from tripflow.operators.quantile_select import DEFAULT_ACCURACY
from tripflow.operators.summarise import Measure, Summary, summarise_many
from tripflow.plans import specs
from tripflow.session import scratch_path
from tripflow.sources.io import small_result


def out_of_month_rows(
    df: DataFrame, c: TripColumns = TRIP, year: int = specs.TARGET_YEAR, month: int = specs.TARGET_MONTH
) -> DataFrame:
    return P.run(df, P.count_figure("rows", specs.out_of_month(c, year, month)))


def profile(
    df: DataFrame,
    c: TripColumns = TRIP,
    quantile_method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
    digits: int = 6,
    duplicates: DataFrame | None = None,
    year: int = specs.TARGET_YEAR,
    month: int = specs.TARGET_MONTH,
) -> dict[str, DataFrame]:
    """Every profile figure in five scans of ``df``:

    1. one aggregate: shape, statistics, nulls, ranges, out-of-month,
       every rule check, and the fare range for the histogram;
    2. one GROUPING SETS aggregate: rows by date, by hour, by vendor, by
       payment type and by fare bin (partial aggregation, so only group
       rows are shuffled);
    3. whole-row duplicates (one shuffle of the distinct rows), unless
       ``duplicates`` is given - e.g. ``SilverBuild.duplicate_stats()``,
       which reads the copy counts the silver dedupe already staged, so a
       pipeline shuffles its rows once, not twice;
    4-5. exact quantiles: bucket round(s), then window histograms (their
       first window, each column's finite range, rides along in scan 1).

    Small results are materialised once (one-row aggregates as local
    frames, the breakdowns as a scratch table) and every figure reads them.
    """
    lo, hi, bins = specs.FARE_HISTOGRAM
    specs.check_trips(df, c)
    checks = specs.profile_checks(c, year, month)
    single = P.one_pass(
        df,
        {
            "shape": P.shape_figure(df),
            "describe": P.describe_figure(specs.describe_columns(c), digits),
            "nulls": P.null_figure(df),
            "ranges": P.ranges_figure(specs.range_columns(c), digits),
            "out_of_month": P.count_figure("rows", specs.out_of_month(c, year, month)),
            "checks": P.checks_figure(checks),
            "fare_range": P.histogram_range_figure(c.fare, lo, hi),
            "quantile_ranges": P.finite_range_figure(specs.quantile_columns(c)),
        },
    )
    qranges = {r["column"]: (r["lo"], r["hi"]) for r in single["quantile_ranges"].collect()}
    total = single["shape"].first()["rows"]
    r = single["fare_range"].first()
    mn, mx = P.histogram_edges(r["mn"], r["mx"])

    fare_bin = "_fare_bin"
    keyed = P.with_bin(
        df.select(c.pickup, c.vendor, c.payment, c.fare).withColumns(
            {c.date: F.to_date(c.pickup), c.hour: F.hour(c.pickup)}
        ),
        c.fare, lo, hi, mn, mx, bins, fare_bin,
    )
    n = Measure("count", "count")
    breakdowns = [
        Summary("by_date", (c.date,), (n,), order=((c.date, True),)),
        Summary("by_hour", (c.hour,), (n,), order=((c.hour, True),)),
        Summary("vendor_dist", (c.vendor,), (n,), order=((c.vendor, True),)),
        Summary("payment_dist", (c.payment,), (n,), order=((c.payment, True),)),
        Summary("fare_bins", (fare_bin,), (n,)),
    ]
    combined, makers = summarise_many(keyed, breakdowns)
    # group rows only (dates + 24 hours + codes + bins): written once to
    # the shared scratch folder, read by each breakdown
    path = scratch_path(df.sparkSession, "profile-breakdowns")
    combined.write.parquet(path)
    combined = df.sparkSession.read.parquet(path)
    grouped = {name: make(combined) for name, make in makers.items()}

    def pct(frame: DataFrame) -> DataFrame:
        return frame.withColumn("pct", F.round(F.col("count") / F.lit(total) * 100, 2))

    dups = small_result(P.duplicate_stats(df) if duplicates is None else duplicates, 1)
    return {
        "shape": single["shape"],
        "describe": single["describe"],
        "nulls": single["nulls"],
        "duplicates": dups,
        "by_date": grouped["by_date"],
        "by_hour": grouped["by_hour"],
        "vendor_dist": pct(grouped["vendor_dist"]),
        "payment_dist": pct(grouped["payment_dist"]),
        "ranges": single["ranges"],
        "quantiles": P.quantiles(
            df, specs.quantile_columns(c), specs.QUANTILE_PROBS, quantile_method, accuracy, ranges=qranges
        ),
        "out_of_month": single["out_of_month"],
        "issues": P.with_duplicates(single["checks"], df, len(checks), stats=dups),
        "fare_histogram": P.bins_table(
            grouped["fare_bins"].filter(F.col(fare_bin).isNotNull()), mn, mx, bins, bin_col=fare_bin
        ),
    }
