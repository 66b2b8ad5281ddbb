"""Reports over the layers: counts, rankings, the hour x weekday matrix
and payment shares.  All inputs are small gold tables except the two
layer counts (aggregates of their layers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.columns import TRIP, TripColumns
from tripflow.functions.expr import label
from tripflow.operators.report import layer_report, pivot_matrix, share
from tripflow.operators.summarise import top_k
from tripflow.plans import specs


def vendor_comparison(by_vendor: DataFrame) -> DataFrame:
    return by_vendor.select("vendor_name", "total_trips", "total_revenue", "avg_fare", "avg_tip_pct")


def payment_ranking(by_payment: DataFrame, c: TripColumns = TRIP) -> DataFrame:
    return by_payment.orderBy(F.col("total_trips").desc(), F.col(c.payment).asc_nulls_first())


def top_hours(by_hour: DataFrame, k: int = 5, c: TripColumns = TRIP) -> DataFrame:
    return top_k(by_hour, [("total_trips", False)], k, keys=[c.hour])


def first_dates(by_date: DataFrame, k: int = 5, c: TripColumns = TRIP) -> DataFrame:
    return top_k(by_date, [(c.date, True)], k)


def busy_hours(silver: DataFrame, k: int = 10, c: TripColumns = TRIP) -> DataFrame:
    """Busiest pickup hours straight from silver (24 groups, top k)."""
    counts = silver.groupBy(c.hour).agg(F.count(F.lit(1)).alias("count"))
    return top_k(counts, [("count", False)], k, keys=[c.hour])


def hour_weekday_matrix(by_dow_hour: DataFrame, c: TripColumns = TRIP) -> DataFrame:
    return pivot_matrix(by_dow_hour, c.dayofweek, c.hour, "total_trips", list(range(24)), prefix="h")


def payment_share(by_payment: DataFrame, c: TripColumns = TRIP) -> DataFrame:
    """Share of trips per payment type (1 decimal), labelled without a
    default: unmapped codes keep their code as the display name."""
    named = by_payment.select(
        c.payment,
        "total_trips",
        F.coalesce(label(c.payment, specs.PAYMENT_NAMES), F.col(c.payment).cast("string")).alias("display_name"),
    )
    return share(named, "total_trips", "share_pct", 1).orderBy(
        F.col("total_trips").desc(), F.col(c.payment).asc_nulls_first()
    )


def report(
    bronze: DataFrame, silver: DataFrame, gold: dict[str, DataFrame], c: TripColumns = TRIP
) -> dict[str, DataFrame]:
    return {
        "layers": layer_report(bronze, silver),
        "top_hours": top_hours(gold["by_hour"], c=c),
        "first_dates": first_dates(gold["by_date"], c=c),
        "vendor": vendor_comparison(gold["by_vendor"]),
        "payment": payment_ranking(gold["by_payment"], c),
        "heatmap": hour_weekday_matrix(gold["by_dow_hour"], c),
        "payment_share": payment_share(gold["by_payment"], c),
        "busy_hours": busy_hours(silver, c=c),
    }
