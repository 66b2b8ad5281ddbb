"""Quantile sketches that are stored by day and merged for any range.

A KLL sketch of a column takes some kilobytes, merges with others, and
gives a value whose rank differs from the asked one by at most a share
``rank_error(size)`` of the rows (with 99 % certainty), whatever their number.  So
quantiles over a year come from 365 small rows instead of its trips.  Exact
quantiles are :mod:`tripflow.operators.quantile_select`'s.

Nulls, NaN and infinities are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expr import quoted

#: Size of a sketch; a rank error of 0.7 %.
SIZE = 600


def rank_error(size: int = SIZE) -> float:
    """The KLL sketch's normalised rank error (published fit, 99 %)."""
    return 2.296 / size**0.9021


def _name(column: str) -> str:
    return f"_kll_{column}"


def quantile_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """One row per group: its keys and a sketch of each column."""
    aggs = []
    for c in columns:
        x = quoted(c).cast("double")
        x = F.when(F.abs(x) < float("inf"), x)  # neither NaN nor infinite
        aggs.append(F.kll_sketch_agg_double(x, F.lit(size)).alias(_name(c)))
    return df.groupBy(*[quoted(k) for k in keys]).agg(*aggs)


def merged_quantiles(sketches: DataFrame, columns: Sequence[str], probs: Sequence[float], size: int = SIZE) -> DataFrame:
    """column, prob, value, rank_error of all rows that the sketches cover;
    value is null where they hold none."""
    merged = sketches.agg(*[F.kll_merge_agg_double(quoted(_name(c)), F.lit(size)).alias(_name(c)) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(p)).alias("prob"),
            F.when(F.kll_sketch_get_n_double(quoted(_name(c))) > 0, F.kll_sketch_get_quantile_double(quoted(_name(c)), F.lit(float(p)))).alias("value"),
            F.lit(rank_error(size)).alias("rank_error"),
        )
        for c in columns
        for p in probs
    ]
    return merged.select(F.inline(F.array(*rows)))


def within_bound(df: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``quantiles`` with the exact rank range of each value in ``df`` and
    whether the asked rank lies within the error of it: one scan."""
    asked = quantiles.collect()  # one row per column and probability
    aggs = []
    for i, q in enumerate(asked):
        x = quoted(q["column"]).cast("double")
        sound = F.abs(x) < float("inf")
        aggs += [F.count_if(sound).alias(f"n{i}"), F.count_if(sound & (x < q["value"])).alias(f"l{i}"), F.count_if(sound & (x <= q["value"])).alias(f"u{i}")]
    got = df.agg(*aggs).first()
    rows = []
    for i, q in enumerate(asked):
        n, low, high = got[f"n{i}"], got[f"l{i}"], got[f"u{i}"]
        inside = n == 0 or (low / n - q["rank_error"] <= q["prob"] <= high / n + q["rank_error"])
        rows.append((q["column"], q["prob"], n, bool(inside)))
    return df.sparkSession.createDataFrame(rows, "column string, prob double, rows long, within boolean")
