"""Exact discrete quantiles with bounded memory, for any number of rows.

``percentile_approx`` is exact only when its sketch can hold about
1/accuracy entries per task and per quantile, its answer moves with the
partitioning, and it is an object-based aggregate (several times slower
per row than a plain count).  Here each quantile is *selected* with plain
hash aggregates instead:

1. one aggregate gives each column's finite min and max;
2. a *bucket round* splits a window ``[lo, hi]`` into ``B`` equal-width
   buckets and returns, per bucket, the row count of every target's
   filter plus the bucket's observed min and max - at most ``B + 3``
   small rows.  The bucket index is monotone in the value, so walking the
   buckets gives the exact rank of every bucket edge; the target's window
   becomes the observed ``[min, max]`` of the bucket holding its rank;
3. bucket rounds go on until the bucket that holds the rank has one
   distinct value, at any number of rows.

A bucket round always splits a window of two or more distinct values, so
the search ends: a round narrows a window of doubles by a factor of
``B``, so a few rounds exhaust their 53 bits.  All
targets advance together: targets sharing a column and window share one
bucket job, and every round is a hash aggregate with map-side partial
aggregation, so a value repeated by a third of all rows collapses in each
task before the shuffle.  Nulls and NaN are ignored, and both infinities
have their own buckets.  Integers and decimals are selected as what they
are, so that large ones don't round to doubles.

Rank follows the inverse-CDF ("discrete") definition: the smallest value
whose cumulative count reaches ``max(1, ceil(p * n))``.
"""

from __future__ import annotations

import bisect
import decimal
import math
from collections.abc import Hashable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKETS = 4096
DEFAULT_ACCURACY = 10_000  # sketch accuracy of the approximate method


@dataclass
class QuantileTarget:
    key: Hashable
    column: str
    prob: float
    where: Column | None = field(default=None, compare=False)

    # search state
    n: int | None = None
    k: int | None = None
    lo: object = None  # current window, finite, inclusive
    hi: object = None
    below: int = 0  # rows of the target under the window
    value: float | None = None
    done: bool = False

    def filter_key(self) -> str | None:
        return None if self.where is None else str(self.where)


def discrete_rank(n: int, prob: float) -> int:
    """1-based rank of the ``prob`` quantile among ``n`` sorted values."""
    return max(1, n - math.floor(n - n * prob))


# Expressions are written as SQL text (one JVM call each): these rounds
# build many small predicates, and building them call by call costs more
# driver time than the jobs themselves on small inputs.


def _q(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def double_sql(v: float) -> str:
    """A double as an exact SQL literal, also NaN and infinities."""
    v = float(v)
    if v != v:
        return "double('NaN')"
    return f"double('{'-' if v < 0 else ''}Infinity')" if math.isinf(v) else f"{v!r}D"


_d = double_sql


def _literal(v) -> str:
    """A value of a column's own type as SQL."""
    return double_sql(v) if isinstance(v, float) else f"CAST('{v}' AS DECIMAL(38,{_scale(v)}))"


def _scale(v) -> int:
    return max(0, -v.as_tuple().exponent) if isinstance(v, decimal.Decimal) else 0


def _equal_width(x: str, lo, hi, buckets: int) -> str:
    """Bucket 0..B-1 of a finite ``x`` in ``[lo, hi]``; monotone in ``x``.
    Halves keep ``hi - lo`` finite for any finite bounds.  Other types than
    doubles are counted off in whole steps of their last place."""
    if lo == hi:
        return "0"
    if not isinstance(lo, float):
        places = max(_scale(lo), _scale(hi))
        steps = int((decimal.Decimal(hi) - decimal.Decimal(lo)).scaleb(places)) + 1
        wide = -(-steps // buckets)
        unit = decimal.Decimal(1).scaleb(-places)
        offset = f"CAST(({x} - {_literal(lo)}) / {_literal(unit)} AS DECIMAL(38,0))"
        return f"CAST(floor({offset} / CAST('{wide}' AS DECIMAL(38,0))) AS INT)"
    if hi / 2 - lo / 2 > 0:
        scaled = f"(({x} / 2D - {_d(lo / 2)}) / {_d(hi / 2 - lo / 2)} * {buckets}D)"
    else:  # adjacent subnormal bounds: halving would round the width to 0
        scaled = f"(({x} - {_d(lo)}) / {_d(hi - lo)} * {buckets}D)"
    return f"CAST(least(floor({scaled}), {buckets - 1}) AS INT)"


def _in_range(column: str, lo, hi) -> str:
    c = _q(column)
    return f"({c} >= {_literal(lo)} AND {c} <= {_literal(hi)})"


def _own(df: DataFrame, column: str) -> str:
    """The column as SQL in the type it is selected in: doubles for floating
    columns, else decimals that hold every value."""
    kind = df.select(F.expr(_q(column))).schema[0].dataType
    if isinstance(kind, T.DecimalType):
        return f"CAST({_q(column)} AS DECIMAL(38,{kind.scale}))"
    if isinstance(kind, T.IntegralType):
        return f"CAST({_q(column)} AS DECIMAL(38,0))"
    return f"CAST({_q(column)} AS DOUBLE)"


@dataclass
class _Window:
    """One bucket job input: a column, its window and the targets in it."""

    column: str
    value: str  # SQL of the column in its own type
    lo: object  # None: the column's whole finite range (first round)
    hi: object
    first: bool
    targets: list[QuantileTarget]

    def bucket(self, buckets: int) -> str:
        x = self.value
        if not self.first:
            return f"CASE WHEN {_in_range(self.column, self.lo, self.hi)} THEN {_equal_width(x, self.lo, self.hi, buckets)} END"
        finite = "CAST(NULL AS INT)" if self.lo is None else _equal_width(x, self.lo, self.hi, buckets)
        if not x.endswith("AS DOUBLE)"):
            return finite
        return (
            f"CASE WHEN {x} IS NULL OR isnan({x}) THEN CAST(NULL AS INT) "
            f"WHEN {x} = double('inf') THEN {buckets} WHEN {x} = double('-inf') THEN -1 ELSE {finite} END"
        )

    def pushdown(self) -> str:
        if self.first:
            return f"{_q(self.column)} IS NOT NULL"
        return _in_range(self.column, self.lo, self.hi)


def _with_filters(df: DataFrame, columns: Sequence[str], targets: Sequence[QuantileTarget]) -> tuple[DataFrame, dict]:
    """``df`` pruned to ``columns`` plus one boolean column per distinct
    target filter (null -> false); returns the frame and filter-key -> SQL
    name (``TRUE`` for no filter)."""
    names: dict[str | None, str] = {}
    cols = [F.col(c) for c in dict.fromkeys(columns)]
    for t in targets:
        key = t.filter_key()
        if key in names:
            continue
        if t.where is None:
            names[key] = "TRUE"
        else:
            names[key] = f"_f{len(cols)}"
            cols.append(F.coalesce(t.where, F.lit(False)).alias(names[key]))
    return df.select(*cols), names


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Finite min and max of every column, one aggregate.  Any superset of
    a target's rows gives a valid first window."""
    aggs = []
    for i, c in enumerate(columns):
        x = _own(df, c)
        fx = f"CASE WHEN NOT isnan({x}) AND abs({x}) != double('inf') THEN {x} END" if "DOUBLE" in x else x
        aggs += [F.expr(f"min({fx})").alias(f"lo{i}"), F.expr(f"max({fx})").alias(f"hi{i}")]
    row = tuple(df.agg(*aggs).first())
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}


def _bucket_round(df: DataFrame, windows: Sequence[_Window], buckets: int) -> None:
    """One job for all windows: per (window, bucket) the count of each
    distinct target filter and the bucket's min / max; then every target
    moves to the bucket that holds its rank."""
    targets = [t for w in windows for t in w.targets]
    base, names = _with_filters(df, [w.column for w in windows], targets)
    fsql = list(dict.fromkeys(names.values()))
    counts = [F.expr("count(1)" if f == "TRUE" else f"count_if({f})").alias(f"c{i}") for i, f in enumerate(fsql)]
    if len(windows) == 1:
        w = windows[0]
        rows = base.where(F.expr(w.pushdown())).select(
            F.lit(0).alias("_w"), F.expr(w.bucket(buckets)).alias("_b"),
            F.expr(w.value).alias("_x"), *[F.col(f) for f in fsql if f != "TRUE"],
        )
    else:
        # a row may fall in several windows: one (window, bucket) pair each
        pairs = ", ".join(
            f"named_struct('w', {i}, 'b', {w.bucket(buckets)}, 'x', {w.value})"
            for i, w in enumerate(windows)
        )
        # only rows inside some window are expanded (after the first
        # round the windows are narrow: this skips almost every row, and
        # the OR of ranges reaches the Parquet reader)
        inside = " OR ".join(dict.fromkeys(w.pushdown() for w in windows))
        rows = base.where(F.expr(inside)).select(
            F.expr(f"inline(array({pairs}))").alias("_w", "_b", "_x"), *[F.col(f) for f in fsql if f != "TRUE"]
        )
    hist = [
        tuple(r)
        for r in rows.where(F.col("_b").isNotNull())
        .groupBy("_w", "_b")
        .agg(F.min("_x").alias("mn"), F.max("_x").alias("mx"), *counts)
        .collect()  # at most len(windows) * (buckets + 3) rows
    ]
    by_window: dict[int, list[tuple]] = {}
    for r in hist:
        by_window.setdefault(r[0], []).append(r)
    for i, w in enumerate(windows):
        ordered = sorted(by_window.get(i, []), key=lambda r: r[1])
        # cumulative counts per filter: bisect instead of a walk per target
        cum: dict[int, list[int]] = {}
        for t in w.targets:
            j = fsql.index(names[t.filter_key()])
            if j not in cum:
                acc, run = [], 0
                for r in ordered:
                    run += r[4 + j]
                    acc.append(run)
                cum[j] = acc
            acc = cum[j]
            if w.first:
                t.n = acc[-1] if acc else 0
                if t.n == 0:
                    t.value, t.done = None, True
                    continue
                t.k = discrete_rank(t.n, t.prob)
            need = t.k - t.below
            pos = bisect.bisect_left(acc, need)
            if pos == len(acc):  # cannot happen with exact counts
                raise RuntimeError(f"quantile rank {t.k} of {t.column!r} not found in its window")
            seen = acc[pos - 1] if pos else 0
            _enter_bucket(t, ordered[pos], seen, buckets)


def _enter_bucket(t: QuantileTarget, r: tuple, seen: int, buckets: int) -> None:
    b, mn, mx = r[1], r[2], r[3]
    if b == -1:
        t.value, t.done = float("-inf"), True
    elif b == buckets:
        t.value, t.done = float("inf"), True
    elif mn == mx:
        t.value, t.done = mn, True
    else:
        t.lo, t.hi = mn, mx
        t.below += seen


def _rounds(df: DataFrame, windows: Sequence[_Window], buckets: int) -> None:
    """One job for the windows of each type."""
    by_type: dict[str, list[_Window]] = {}
    for w in windows:
        by_type.setdefault(w.value.rsplit(" AS ", 1)[1], []).append(w)
    for same in by_type.values():
        _bucket_round(df, same, buckets)


def exact_quantiles(
    df: DataFrame,
    targets: Sequence[QuantileTarget],
    accuracy: int = DEFAULT_BUCKETS,
    max_rounds: int = 1000,
    ranges: dict[str, tuple[float | None, float | None]] | None = None,
) -> dict[Hashable, float | None]:
    """Exact discrete quantiles for every target; ``None`` when it has no rows.

    ``accuracy`` is the number of buckets a round splits a window into
    (each bucket job returns at most that many rows per window).  Jobs:
    one for the ranges, one per bucket round.  Values of integer and
    decimal columns come back as decimals.  ``ranges`` (from
    :func:`column_ranges`, possibly over a superset of the rows) saves the
    first job when several selections run over the same columns.
    """
    targets = list(targets)
    if not targets:
        return {}
    buckets = max(2, int(accuracy))
    columns = list(dict.fromkeys(t.column for t in targets))
    value = {c: _own(df, c) for c in columns}
    known = {c: r for c, r in (ranges or {}).items() if c in value and value[c].endswith("AS DOUBLE)")}
    missing = [c for c in columns if c not in known]
    ranges = {**known, **(column_ranges(df, missing) if missing else {})}
    first = []
    for c in columns:
        lo, hi = ranges[c]
        members = [t for t in targets if t.column == c]
        first.append(_Window(c, value[c], lo, hi, True, members))
    _rounds(df, first, buckets)
    for _ in range(max_rounds):
        open_ = [t for t in targets if not t.done]
        if not open_:
            break
        windows: dict[tuple, _Window] = {}
        for t in open_:
            key = (t.column, t.lo, t.hi)
            if key not in windows:
                windows[key] = _Window(t.column, value[t.column], t.lo, t.hi, False, [])
            windows[key].targets.append(t)
        _rounds(df, list(windows.values()), buckets)
    else:
        raise RuntimeError("quantile selection did not converge")
    return {t.key: t.value for t in targets}
