"""Interquartile-range outlier removal and its self-tuning.

Bounds for a column are ``q1 - m * iqr`` and ``q3 + m * iqr``; a row is
kept when ``lower <= x <= upper``.  Filtering several columns is
*sequential*: the quartiles of column k are taken over the rows that
survived columns 1..k-1 (``mode="independent"`` takes all bounds from
the input instead - a different, order-free result).

Tuning evaluates several multipliers at once.  For column k the
quartiles of every multiplier, each restricted by that multiplier's
earlier bounds, come from one conditional histogram
(:mod:`tripflow.operators.rank_index`), so the cost is one job per column plus
one counting job for any number of multipliers.  Quartiles are exact;
bounds of a single filter are selected by
:mod:`tripflow.operators.quantile_select`; ``method="approx"`` uses a single
``percentile_approx`` sketch per quartile instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.expr import quoted
from tripflow.operators.quantile_select import (
    DEFAULT_ACCURACY,
    QuantileTarget,
    column_ranges,
    double_sql,
    exact_quantiles,
)
from tripflow.operators.rank_index import RankTarget, ranked_values
from tripflow.sources.io import local_frame, small_result

QUARTILES = (0.25, 0.75)


@dataclass(frozen=True)
class Bounds:
    column: str
    q1: float | None
    q3: float | None
    multiplier: float

    @property
    def iqr(self) -> float | None:
        return None if self.q1 is None or self.q3 is None else self.q3 - self.q1

    @property
    def lower(self) -> float | None:
        return None if self.iqr is None else self.q1 - self.multiplier * self.iqr

    @property
    def upper(self) -> float | None:
        return None if self.iqr is None else self.q3 + self.multiplier * self.iqr

    def keep_sql(self) -> str:
        """``lower <= x <= upper`` as SQL; no bounds (no values) keeps every row."""
        if self.lower is None:
            return "TRUE"
        x = "`" + self.column.replace("`", "``") + "`"
        return f"({x} >= {double_sql(self.lower)} AND {x} <= {double_sql(self.upper)})"

    def keep(self) -> Column:
        # one JVM call per predicate (tuning builds dozens of them)
        return F.expr(self.keep_sql())


BOUNDS_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("multiplier", T.DoubleType(), False),
        T.StructField("q1", T.DoubleType(), True),
        T.StructField("q3", T.DoubleType(), True),
        T.StructField("iqr", T.DoubleType(), True),
        T.StructField("lower", T.DoubleType(), True),
        T.StructField("upper", T.DoubleType(), True),
    ]
)


def bounds_table(spark, bounds: Sequence[Bounds]) -> DataFrame:
    """The (small, one row per column) bounds as a DataFrame."""
    rows = [
        (i, b.column, float(b.multiplier), b.q1, b.q3, b.iqr, b.lower, b.upper)
        for i, b in enumerate(bounds, start=1)
    ]
    return local_frame(spark, rows, BOUNDS_SCHEMA)


def _quartiles(
    df: DataFrame,
    wanted: Sequence[tuple[object, str, Column | None]],
    method: str,
    accuracy: int,
    ranges: dict | None = None,
) -> dict[object, tuple[float | None, float | None]]:
    """q1, q3 for each (key, column, filter) in one batched selection."""
    if method == "exact":
        targets = [
            QuantileTarget((key, p), column, p, where)
            for key, column, where in wanted
            for p in QUARTILES
        ]
        found = exact_quantiles(df, targets, accuracy=accuracy, ranges=ranges)
        as_float = lambda v: None if v is None else float(v)
        return {key: tuple(as_float(found[(key, p)]) for p in QUARTILES) for key, _, _ in wanted}
    if method != "approx":
        raise ValueError("method must be 'exact' or 'approx'")
    aggs = []
    for i, (_, column, where) in enumerate(wanted):
        x = quoted(column).cast("double")
        x = F.when(~F.isnan(x) if where is None else where & ~F.isnan(x), x)  # NaN has no rank
        aggs.append(F.percentile_approx(x, list(QUARTILES), accuracy).alias(f"q{i}"))
    row = df.agg(*aggs).first()
    out = {}
    for i, (key, _, _) in enumerate(wanted):
        qs = row[f"q{i}"]
        out[key] = (None, None) if qs is None else (qs[0], qs[1])
    return out


def _indexed_quartiles(
    df: DataFrame, column: str, wanted: Sequence[tuple[object, str, Column | None]]
) -> dict[object, tuple[float | None, float | None]]:
    """q1, q3 of one column for each (key, column, filter); one job."""
    found = ranked_values(df, column, [RankTarget((key, p), p, where) for key, _, where in wanted for p in QUARTILES])
    as_float = lambda v: None if v is None else float(v)
    return {key: tuple(as_float(found[(key, p)]) for p in QUARTILES) for key, _, _ in wanted}


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 3.0,
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
) -> list[Bounds]:
    """Bounds of each column over all of ``df`` (independent)."""
    qs = _quartiles(df, [(c, c, None) for c in columns], method, accuracy)
    return [Bounds(c, *qs[c], multiplier) for c in columns]


def iqr_filter_with_bounds(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 3.0,
    mode: str = "sequential",
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
) -> tuple[DataFrame, list[Bounds]]:
    """Filtered rows and the bounds used, per column in order.

    ``df`` is scanned once per column (sequential) or once (independent);
    give it a cheap-to-scan input, e.g. a staged Parquet table.
    """
    if mode == "independent":
        bounds = iqr_bounds(df, columns, multiplier, method, accuracy)
        out = df
        for b in bounds:
            out = out.filter(b.keep())
        return out, bounds
    if mode != "sequential":
        raise ValueError("mode must be 'sequential' or 'independent'")
    bounds: list[Bounds] = []
    out = df
    ranges = column_ranges(df, columns) if method == "exact" else None  # one job for all columns
    for c in columns:
        # bounds of column k on the rows kept so far, as one filter on the input
        keep = F.expr(" AND ".join(b.keep_sql() for b in bounds)) if bounds else None
        qs = _quartiles(df, [(c, c, keep)], method, accuracy, ranges)
        bounds.append(Bounds(c, *qs[c], multiplier))
    for b in bounds:
        out = out.filter(b.keep())
    return out, bounds


def iqr_filter(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 3.0,
    mode: str = "sequential",
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    return iqr_filter_with_bounds(df, columns, multiplier, mode, method, accuracy)[0]


CANDIDATE_COLUMNS = "position int, multiplier double, rows_after bigint, rows_removed bigint, retain_ratio double, remove_ratio double"


@dataclass
class Tuning:
    """Result of evaluating several multipliers on the same rows."""

    table: DataFrame  # one row per multiplier (lazy: one counting job)
    bounds: dict[float, list[Bounds]]
    multipliers: tuple[float, ...]


def iqr_candidates(
    df: DataFrame,
    columns: Sequence[str],
    multipliers: Sequence[float],
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
) -> Tuning:
    """Rows kept / removed and ratios for each multiplier (sequential filters).

    Same results as running the sequential filter once per multiplier;
    the ratios are 0.0 for an empty input.
    """
    ms = tuple(float(m) for m in multipliers)
    bounds: dict[float, list[Bounds]] = {m: [] for m in ms}
    for c in columns:
        wanted = []
        for m in ms:
            keep = F.expr(" AND ".join(b.keep_sql() for b in bounds[m])) if bounds[m] else None
            wanted.append((m, c, keep))
        qs = _indexed_quartiles(df, c, wanted) if method == "exact" else _quartiles(df, wanted, method, accuracy)
        for m in ms:
            bounds[m].append(Bounds(c, *qs[m], m))

    def keep_all(m: float) -> Column:
        return F.expr("count_if(coalesce(" + " AND ".join(["TRUE", *(b.keep_sql() for b in bounds[m])]) + ", FALSE))")

    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[keep_all(m).alias(f"k{i}") for i, m in enumerate(ms)],
    )
    n = F.col("n")
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(m).cast("double").alias("multiplier"),
            F.col(f"k{i}").alias("rows_after"),
            (n - F.col(f"k{i}")).alias("rows_removed"),
            F.when(n > 0, F.col(f"k{i}") / n).otherwise(F.lit(0.0)).alias("retain_ratio"),
            F.when(n > 0, (n - F.col(f"k{i}")) / n).otherwise(F.lit(0.0)).alias("remove_ratio"),
        )
        for i, m in enumerate(ms)
    ]
    table = counts.select(F.inline(F.array(*rows)))
    return Tuning(table, bounds, ms)


def pick_multiplier(candidates: DataFrame, min_retain_ratio: float = 0.9) -> DataFrame:
    """One row: the smallest multiplier whose retain ratio reaches the
    threshold; if none does, the highest retain ratio (earliest on ties)."""
    qualified = F.col("retain_ratio") >= F.lit(min_retain_ratio)
    return candidates.orderBy(
        qualified.desc(),
        F.when(qualified, F.col("multiplier")).asc_nulls_last(),
        F.col("retain_ratio").desc(),
        F.col("position").asc(),
    ).limit(1)


def choose_multiplier(candidates: DataFrame, min_retain_ratio: float = 0.9) -> float:
    row = pick_multiplier(candidates, min_retain_ratio).first()
    if row is None:
        raise ValueError("no candidates to choose from")
    return float(row["multiplier"])


def tuned_iqr_filter(
    df: DataFrame,
    columns: Sequence[str],
    multipliers: Sequence[float],
    min_retain_ratio: float = 0.9,
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
) -> tuple[DataFrame, Tuning, float]:
    """Evaluate, pick, and filter with the picked multiplier's bounds
    (found during evaluation; nothing is recomputed)."""
    tuning = iqr_candidates(df, columns, multipliers, method, accuracy)
    # one row per multiplier: kept as a local frame, so that reading it
    # again never counts again
    tuning.table = small_result(tuning.table, len(tuning.multipliers))
    chosen = choose_multiplier(tuning.table, min_retain_ratio)
    out = df
    for b in tuning.bounds[chosen]:
        out = out.filter(b.keep())
    return out, tuning, chosen
