"""Reports over layers and gold tables: layer counts, pivots, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_report(before: DataFrame, after: DataFrame, digits: int = 1) -> DataFrame:
    """original_rows, cleaned_rows, removed, removed_pct (null for no rows).

    Both counts are aggregates of their own layer; the second is a scalar
    subquery, so this is one lazy query and no count passes through the
    driver.
    """
    cleaned = after.select(F.count(F.lit(1))).scalar()
    removed = F.col("original_rows") - F.col("cleaned_rows")
    return (
        before.agg(F.count(F.lit(1)).alias("original_rows"))
        .withColumn("cleaned_rows", cleaned)
        .select(
            "original_rows",
            "cleaned_rows",
            removed.alias("removed"),
            F.round(F.try_divide(removed, F.col("original_rows")) * 100, digits).alias("removed_pct"),
        )
    )


def pivot_matrix(
    df: DataFrame,
    row_key: str,
    column_key: str,
    value: str,
    column_values: Sequence[object],
    prefix: str = "",
) -> DataFrame:
    """Wide matrix: one row per ``row_key``, one column per listed value.

    The value list is explicit, so Spark needs no extra job to discover
    it; a missing cell is null.
    """
    wide = df.groupBy(row_key).pivot(column_key, list(column_values)).agg(F.max(value))
    if prefix:
        wide = wide.select(
            row_key, *[F.col(str(v)).alias(f"{prefix}{v:02d}" if isinstance(v, int) else f"{prefix}{v}") for v in column_values]
        )
    return wide.orderBy(row_key)


def share(df: DataFrame, value: str, name: str = "share_pct", digits: int = 1) -> DataFrame:
    """Each row's share of the column total, in percent (small inputs:
    the total is a scalar subquery over ``df``)."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, F.round(F.col(value) / total * 100, digits))
