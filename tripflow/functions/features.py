"""Derived silver columns: duration, calendar parts, tip share, speed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.columns import TRIP, TripColumns
from tripflow.functions.expr import safe_div, seconds_between


def feature_columns(c: TripColumns = TRIP) -> dict[str, Column]:
    """The seven derived columns, in silver order.

    ``speed`` uses the already rounded duration, as the silver layer
    defines it; divisions by zero give null rather than failing.
    """
    duration = F.round(seconds_between(c.pickup, c.dropoff) / 60, 2)
    return {
        c.duration_min: duration,
        c.hour: F.hour(c.pickup),
        c.date: F.to_date(c.pickup),
        c.dayofweek: F.dayofweek(c.pickup),
        c.week: F.weekofyear(c.pickup),
        c.tip_pct: F.round(safe_div(F.col(c.tip), F.col(c.fare)) * 100, 2),
        c.speed: F.round(safe_div(F.col(c.distance), F.col(c.duration_min) / 60), 2),
    }


def add_features(df: DataFrame, c: TripColumns = TRIP) -> DataFrame:
    """Append the derived columns: one projection, no extra pass."""
    cols = feature_columns(c)
    speed = cols.pop(c.speed)
    return df.withColumns(cols).withColumn(c.speed, speed)
