"""Data-quality profile: shape, statistics, nulls, duplicates, distributions,
quantiles, rule violations and histograms.

Every figure that is a plain aggregate is computed in a single ``agg``
(one scan, partial aggregation, one row back) and reshaped with
``inline``; only the duplicate count needs a shuffle.  Percentages divide
by a total taken from the same aggregate or from a scalar subquery, never
by a number carried through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.expr import count_if, is_float_type, quoted
from tripflow.operators.quantile_select import DEFAULT_ACCURACY, QuantileTarget, exact_quantiles
from tripflow.sources.io import local_frame, small_result


@dataclass(frozen=True)
class Figure:
    """A profile figure that is a function of one aggregate row.

    ``aggs`` are aliased aggregate expressions (names unique per figure);
    ``reshape`` turns the one-row frame holding them into the result.
    Several figures share one scan with :func:`one_pass`.
    """

    aggs: tuple[Column, ...] = field(compare=False)
    reshape: object = field(compare=False)  # Callable[[DataFrame], DataFrame]


def run(df: DataFrame, fig: Figure) -> DataFrame:
    return fig.reshape(df.agg(*fig.aggs))


def one_pass(df: DataFrame, figures: dict[str, Figure]) -> dict[str, DataFrame]:
    """All figures from ONE aggregate over ``df``.

    The single result row is kept as a local frame (one row, so a proven
    bound), so every figure reads it instead of scanning ``df`` again.
    """
    aggs = [a for fig in figures.values() for a in fig.aggs]
    row = small_result(df.agg(*aggs), 1)
    return {name: fig.reshape(row) for name, fig in figures.items()}


def shape_figure(df: DataFrame, prefix: str = "sh_") -> Figure:
    n = len(df.columns)
    return Figure(
        (F.count(F.lit(1)).alias(f"{prefix}rows"),),
        lambda r: r.select(F.col(f"{prefix}rows").alias("rows"), F.lit(n).alias("columns")),
    )


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return run(df, shape_figure(df))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _r(expr: str, digits: int | None) -> str:
    """:func:`rnd` as SQL text (none when ``digits`` is None)."""
    return expr if digits is None else f"round(round({expr}, 9), {digits})"


def _rows(structs: Sequence[str]) -> Column:
    """One output row per ``named_struct``; figures are written as SQL
    text (one JVM call each) since they hold many small expressions."""
    return F.expr("inline(array(" + ", ".join(structs) + "))")


def describe_figure(columns: Sequence[str], digits: int | None = None, prefix: str = "ds_") -> Figure:
    aggs = []
    for i, c in enumerate(columns):
        x = f"CAST({_q(c)} AS DOUBLE)"
        for name, fn in (("n", "count"), ("a", "avg"), ("s", "stddev_samp"), ("lo", "min"), ("hi", "max")):
            aggs.append(F.expr(f"{fn}({x})").alias(f"{prefix}{name}{i}"))
    items = [
        f"named_struct('position', {i}, 'column', {_s(c)}, 'count', {prefix}n{i}, "
        f"'mean', {_r(f'{prefix}a{i}', digits)}, 'stddev', {_r(f'{prefix}s{i}', digits)}, "
        f"'min', {prefix}lo{i}, 'max', {prefix}hi{i})"
        for i, c in enumerate(columns)
    ]
    return Figure(tuple(aggs), lambda r: r.select(_rows(items)))


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """count / mean / sample stddev / min / max per column, as numbers.

    One aggregate for all columns; ``digits`` rounds mean and stddev.
    """
    return run(df, describe_figure(columns, digits))


def null_figure(df: DataFrame, columns: Sequence[str] | None = None, prefix: str = "nl_") -> Figure:
    columns = list(columns or df.columns)
    floats = {i for i, c in enumerate(columns) if is_float_type(df.schema[c].dataType)}
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.expr(f"count_if({_q(c)} IS NULL)").alias(f"{prefix}n{i}"))
        if i in floats:
            aggs.append(F.expr(f"count_if(isnan({_q(c)}))").alias(f"{prefix}x{i}"))
    items = [
        f"named_struct('position', {i}, 'column', {_s(c)}, 'nulls', {prefix}n{i}, "
        f"'nans', {f'{prefix}x{i}' if i in floats else 'CAST(0 AS BIGINT)'})"
        for i, c in enumerate(columns)
    ]
    return Figure(tuple(aggs), lambda r: r.select(_rows(items)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, and NaNs for floating columns, in one pass."""
    return run(df, null_figure(df, columns))


def duplicate_stats(df: DataFrame) -> DataFrame:
    """rows, distinct_rows, duplicates and duplicate_pct (0 for no rows).

    One shuffle of the distinct rows; copies are pre-aggregated map-side.
    """
    groups = df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return duplicate_stats_from_copies(groups, "_n")


def duplicate_stats_from_copies(distinct: DataFrame, copies: str) -> DataFrame:
    """:func:`duplicate_stats` from distinct rows that carry their number
    of copies (e.g. the staged silver table): one aggregate over one
    column, no shuffle of the rows."""
    out = distinct.agg(
        F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )
    dup = F.col("rows") - F.col("distinct_rows")
    return out.select(
        "rows",
        "distinct_rows",
        dup.alias("duplicates"),
        F.coalesce(F.round(F.try_divide(dup, F.col("rows")) * 100, 2), F.lit(0.0)).alias("duplicate_pct"),
    )


def count_by(df: DataFrame, key: Column, name: str, count_name: str = "count") -> DataFrame:
    """Rows per value of ``key``, sorted by it."""
    return (
        df.groupBy(key.alias(name))
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(name).asc_nulls_first())
    )


def distribution(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Rows per value and their share of all rows in percent.

    The total is a scalar subquery over the grouped result (a handful of
    rows), so the input is scanned once.
    """
    grouped = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = grouped.select(F.sum("count")).scalar()
    return grouped.withColumn("pct", F.round(F.col("count") / total * 100, digits)).orderBy(
        F.col(column).asc_nulls_first()
    )


def ranges_figure(columns: Sequence[str], digits: int | None = None, prefix: str = "rg_") -> Figure:
    aggs = []
    for i, c in enumerate(columns):
        x = f"CAST({_q(c)} AS DOUBLE)"
        for name, fn in (("lo", "min"), ("hi", "max"), ("a", "avg")):
            aggs.append(F.expr(f"{fn}({x})").alias(f"{prefix}{name}{i}"))
    items = [
        f"named_struct('position', {i}, 'column', {_s(c)}, 'min', {prefix}lo{i}, "
        f"'max', {prefix}hi{i}, 'avg', {_r(f'{prefix}a{i}', digits)})"
        for i, c in enumerate(columns)
    ]
    return Figure(tuple(aggs), lambda r: r.select(_rows(items)))


def value_ranges(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """min, max and mean per column (one aggregate)."""
    return run(df, ranges_figure(columns, digits))


def count_figure(name: str, flag: Column, prefix: str = "ct_") -> Figure:
    """Rows where ``flag`` is true, as a one-column frame ``name``."""
    return Figure((count_if(flag).alias(f"{prefix}{name}"),), lambda r: r.select(F.col(f"{prefix}{name}").alias(name)))


QUANTILE_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("prob", T.DoubleType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def _ranked(c: str) -> Column:
    """What has a rank: NaN has none."""
    x = quoted(c)
    return F.when(~F.isnan(x.cast("double")), x)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
    ranges: dict | None = None,
) -> DataFrame:
    """(column, prob, value) for every column and probability.

    ``exact``: discrete quantiles, all selected together (two jobs on
    small data).  ``approx``: one ``percentile_approx`` aggregate, rank
    error at most rows / accuracy.
    """
    if method == "approx":
        row = df.agg(
            *[F.percentile_approx(_ranked(c), list(probs), accuracy).alias(f"q{i}") for i, c in enumerate(columns)]
        )
        items = [
            F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(f"q{i}")[j].cast("double").alias("value"))
            for i, c in enumerate(columns)
            for j, p in enumerate(probs)
        ]
        return row.select(F.inline(F.array(*items)))
    targets = [QuantileTarget((c, float(p)), c, float(p)) for c in columns for p in probs]
    found = exact_quantiles(df, targets, accuracy=accuracy, ranges=ranges)
    rows = [(c, float(p), None if (v := found[(c, float(p))]) is None else float(v)) for c in columns for p in probs]
    return local_frame(df.sparkSession, rows, QUANTILE_SCHEMA)


@dataclass(frozen=True)
class Check:
    """A data-quality check: rows where ``flag`` is true are issues."""

    name: str
    kind: str
    flag: Column = field(compare=False)


def checks_figure(checks: Sequence[Check], prefix: str = "ck_") -> Figure:
    aggs = tuple(count_if(ch.flag).alias(f"{prefix}{i}") for i, ch in enumerate(checks))
    items = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(ch.name).alias("issue"),
            F.lit(ch.kind).alias("kind"),
            F.col(f"{prefix}{i}").alias("rows"),
        )
        for i, ch in enumerate(checks)
    ]
    return Figure(aggs, lambda r: r.select(F.inline(F.array(*items))))


def with_duplicates(
    counted: DataFrame, df: DataFrame, position: int, only_found: bool = True, stats: DataFrame | None = None
) -> DataFrame:
    """Append the duplicate-row issue (``stats``: a precomputed
    :func:`duplicate_stats` frame, to avoid a second shuffle)."""
    dups = (duplicate_stats(df) if stats is None else stats).select(
        F.lit(position).alias("position"),
        F.lit("duplicate rows").alias("issue"),
        F.lit("duplicate").alias("kind"),
        F.col("duplicates").alias("rows"),
    )
    out = counted.unionByName(dups)
    return out.filter(F.col("rows") > 0) if only_found else out


def issues(
    df: DataFrame,
    checks: Sequence[Check],
    include_duplicates: bool = True,
    only_found: bool = True,
) -> DataFrame:
    """(position, issue, kind, rows): every check counted in one aggregate,
    plus whole-row duplicates (one shuffle); only checks with rows > 0
    unless ``only_found`` is false."""
    counted = run(df, checks_figure(checks))
    if include_duplicates:
        return with_duplicates(counted, df, len(checks), only_found)
    return counted.filter(F.col("rows") > 0) if only_found else counted


def finite_range_figure(columns: Sequence[str], prefix: str = "fr_") -> Figure:
    """Finite min and max per column (the first window of exact quantile
    selection), so a profile scan can carry it instead of a separate job."""
    aggs = []
    for i, c in enumerate(columns):
        x = f"CAST({_q(c)} AS DOUBLE)"
        fx = f"CASE WHEN NOT isnan({x}) AND abs({x}) != double('inf') THEN {x} END"
        aggs += [F.expr(f"min({fx})").alias(f"{prefix}lo{i}"), F.expr(f"max({fx})").alias(f"{prefix}hi{i}")]
    items = [f"named_struct('column', {_s(c)}, 'lo', {prefix}lo{i}, 'hi', {prefix}hi{i})" for i, c in enumerate(columns)]
    return Figure(tuple(aggs), lambda r: r.select(_rows(items)))


def histogram_range_figure(column: str, lo: float, hi: float, prefix: str = "hg_") -> Figure:
    """min and max of the values of ``column`` inside ``[lo, hi]``."""
    x = F.when(F.col(column).between(lo, hi), F.col(column).cast("double"))
    return Figure(
        (F.min(x).alias(f"{prefix}mn"), F.max(x).alias(f"{prefix}mx")),
        lambda r: r.select(F.col(f"{prefix}mn").alias("mn"), F.col(f"{prefix}mx").alias("mx")),
    )


def histogram_edges(mn: float | None, mx: float | None) -> tuple[float, float]:
    """numpy's range rule: observed min..max; +/- 0.5 around a single value."""
    if mn is None:
        return 0.0, 1.0
    mn, mx = float(mn), float(mx)
    return (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)


def _edge(i: Column, mn: float, mx: float, bins: int) -> Column:
    step = (mx - mn) / bins
    return F.when(i == bins, F.lit(mx)).otherwise(i.cast("double") * F.lit(step) + F.lit(mn))


def with_bin(
    df: DataFrame, column: str, lo: float, hi: float, mn: float, mx: float, bins: int, name: str = "bin"
) -> DataFrame:
    """Add the numpy bin index of ``column`` (null outside ``[lo, hi]``).

    numpy's rule: index = trunc((x - mn) / (mx - mn) * bins), the top edge
    folded into the last bin, then corrected against the computed edges.
    """
    x = F.col(column).cast("double")
    raw, i1, i2 = f"_{name}_raw", f"_{name}_i1", f"_{name}_i2"
    # one column per step, so no expression is copied into the next
    return (
        df.withColumn(raw, F.when(F.col(column).between(lo, hi), ((x - F.lit(mn)) / F.lit(mx - mn) * bins).cast("int")))
        .withColumn(i1, F.when(F.col(raw) == bins, F.lit(bins - 1)).otherwise(F.col(raw)))
        .withColumn(i2, F.when(x < _edge(F.col(i1), mn, mx, bins), F.col(i1) - 1).otherwise(F.col(i1)))
        .withColumn(
            name,
            F.when(
                (x >= _edge(F.col(i2) + 1, mn, mx, bins)) & (F.col(i2) != bins - 1), F.col(i2) + 1
            ).otherwise(F.col(i2)),
        )
        .drop(raw, i1, i2)
    )


def bins_table(counts: DataFrame, mn: float, mx: float, bins: int, bin_col: str = "bin") -> DataFrame:
    """Every bin with its edges and count (0 when empty) from (bin, count) rows.

    ``counts`` has at most ``bins`` rows (one per bin index): a proven
    bound, so it is broadcast to the generated list of bins.
    """
    all_bins = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    counts = counts.select(F.col(bin_col).alias("bin"), "count")
    b = F.col("bin")
    return (
        all_bins.join(counts, "bin", "left")
        .select(
            b,
            _edge(b, mn, mx, bins).alias("bin_lo"),
            _edge(b + 1, mn, mx, bins).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        )
        .orderBy("bin")
    )


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int = 50) -> DataFrame:
    """Equal-width histogram of the values in ``[lo, hi]``.

    Bin edges span the *observed* min..max of those values (the numpy
    default): ``bins`` bins, the last one closed; a single distinct value
    gets edges value +/- 0.5.  Bin assignment repeats numpy's rule
    exactly, including its edge corrections.  Empty bins are reported
    with count 0.  Two jobs: min/max (two numbers to the driver), then a
    group-by with at most ``bins`` groups.
    """
    r = run(df, histogram_range_figure(column, lo, hi)).first()
    mn, mx = histogram_edges(r["mn"], r["mx"])
    binned = with_bin(df.select(column), column, lo, hi, mn, mx, bins)
    counts = binned.filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    return bins_table(counts, mn, mx, bins)
