"""Small column-expression helpers, all built-in Spark SQL expressions.

Nothing here runs Python per row: each helper returns a ``Column`` that
Catalyst folds into the surrounding whole-stage-codegen span.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def rnd(c: ColumnOrName, digits: int = 2) -> Column:
    """Round half-up to ``digits`` after first rounding to 9 digits.

    Averages of doubles can differ in the last bits depending on the order
    partial results are merged; the first rounding removes that noise for
    values up to about a million, so their visible digits do not depend on
    partitioning.  Sums grow past that: see :func:`exact_sum`.
    """
    return F.round(F.round(col(c), 9), digits)


def exact_sum(c: ColumnOrName, digits: int) -> Column:
    """Sum of a floating column, the same for any partitioning.

    Values are added as decimals of 9 places (money has fewer), rounded
    half-up to ``digits`` and returned as a double.  NaN and infinities,
    which have no decimal, give the plain sum.
    """
    x = col(c).cast("double")
    odd = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    exact = F.sum(F.when(~odd, x).cast("decimal(28,9)"))
    return F.when(F.count_if(odd) > 0, F.sum(x)).otherwise(F.round(exact, digits).cast("double"))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null for a zero or null divisor (ANSI-safe)."""
    return F.try_divide(col(num), col(den))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds from ``start`` to ``end``: each side truncated to the second."""
    return F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal (TIMESTAMP_NTZ)."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.to_timestamp_ntz(F.lit(value))


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open [first instant, first instant of the next month)."""
    lo = dt.datetime(year, month, 1)
    hi = dt.datetime(year + (month == 12), month % 12 + 1, 1)
    return lo, hi


def in_month(ts: ColumnOrName, year: int, month: int) -> Column:
    """``year(ts) = year AND month(ts) = month`` written as a range.

    The range form reaches the Parquet reader as pushed filters (and row
    group / partition pruning); ``year()``/``month()`` calls would not.
    """
    lo, hi = month_bounds(year, month)
    c = col(ts)
    return (c >= ts_literal(lo)) & (c < ts_literal(hi))


def label(
    code: ColumnOrName,
    mapping: Mapping[object, str],
    default: str | None = None,
) -> Column:
    """Map codes to labels with a ``CASE WHEN`` chain.

    Null and unmapped codes get ``default`` (``None`` leaves them null).
    """
    c = col(code)
    items = list(mapping.items())
    expr = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    for key, text in items[1:]:
        expr = expr.when(c == F.lit(key), F.lit(text))
    return expr.otherwise(F.lit(default).cast("string"))


def is_float_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def present(df: DataFrame, name: str) -> Column:
    """Not null, and not NaN for floating columns (what ``dropna`` keeps).

    Written as explicit predicates so ``IsNotNull`` reaches the Parquet
    reader; ``dropna`` itself plans as an opaque ``AtLeastNNonNulls``.
    """
    c = quoted(name)
    pred = c.isNotNull()
    if is_float_type(df.schema[name].dataType):
        pred = pred & ~F.isnan(c)
    return pred


def count_if(pred: Column) -> Column:
    """Rows where ``pred`` is true (null counts as false)."""
    return F.count_if(F.coalesce(pred, F.lit(False)))


def row_hash(schema: T.StructType, columns: Sequence[str]) -> Column:
    """A 64-bit hash of a row's ``columns``.  Which of them are null goes in
    as well, since a hash passes over nulls."""
    cols = []
    for name in columns:
        c = quoted(name)
        cols += [F.array_sort(F.map_entries(c)) if isinstance(schema[name].dataType, T.MapType) else c, c.isNull()]
    return F.xxhash64(*cols)
