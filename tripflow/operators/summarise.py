"""Grouped summaries from declarative specs: measures, labels, order, top-k.

A gold table is a ``Summary`` value, not a function: group keys, a list
of ``Measure``s, optional code-to-label columns, the sort order and an
optional row limit.  ``summarise`` turns it into one hash aggregate with
a map-side partial phase (a hot key is pre-aggregated inside every map
task, so skew never reaches the shuffle as rows).  A limit becomes a
``TakeOrderedAndProject``: each task keeps its own top k, only k rows per
task travel.  Ties at the cut are broken by the group keys so the result
does not depend on partitioning.

``summarise_many`` computes several summaries over the same input in one
scan with ``GROUPING SETS``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expr import exact_sum, rnd
from tripflow.functions.expr import label as label_expr

AGGS = {
    "count": lambda c: F.count(F.lit(1)),
    "sum": lambda c: F.sum(c),
    "avg": lambda c: F.avg(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


@dataclass(frozen=True)
class Measure:
    """``name = round?(agg(column))``; ``digits=None`` keeps full precision."""

    name: str
    agg: str
    column: str | None = None
    digits: int | None = None

    def expr(self) -> Column:
        if self.exact:
            return exact_sum(self.column, self.digits)
        value = AGGS[self.agg](F.col(self.column) if self.column else None)
        return rnd(value, self.digits) if self.digits is not None else value

    @property
    def exact(self) -> bool:
        """Rounded sums are added as decimals and rounded in the aggregate."""
        return self.agg == "sum" and self.digits is not None

    @property
    def key(self) -> tuple:
        """What measures of several summaries can share."""
        return (self.agg, self.column, self.digits if self.exact else None)


@dataclass(frozen=True)
class Label:
    """A string column ``name`` derived from code column ``code``."""

    name: str
    code: str
    mapping: Mapping[object, str] = field(compare=False)
    default: str | None = None

    def expr(self) -> Column:
        return label_expr(self.code, self.mapping, self.default)


@dataclass(frozen=True)
class Summary:
    name: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    labels: tuple[Label, ...] = ()
    order: tuple[tuple[str, bool], ...] = ()  # (column, ascending)
    limit: int | None = None

    def sort_columns(self) -> list[Column]:
        cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in self.order]
        named = {c for c, _ in self.order}
        # tie-break on the group keys so a cut never depends on partitioning
        cols += [F.col(k).asc_nulls_first() for k in self.keys if k not in named]
        return cols


def finish(df: DataFrame, spec: Summary) -> DataFrame:
    """Labels, order and limit on an aggregated frame."""
    if spec.labels:
        df = df.withColumns({lab.name: lab.expr() for lab in spec.labels})
    if spec.order or spec.limit is not None:
        df = df.orderBy(*spec.sort_columns())
    if spec.limit is not None:
        df = df.limit(spec.limit)
    return df


def summarise(df: DataFrame, spec: Summary) -> DataFrame:
    """One grouped aggregate for ``spec``."""
    agg = df.groupBy(*spec.keys).agg(*[m.expr().alias(m.name) for m in spec.measures])
    return finish(agg, spec)


def top_k(df: DataFrame, by: Sequence[tuple[str, bool]], k: int, keys: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``by``; ``keys`` break ties deterministically."""
    spec = Summary("top_k", tuple(keys), (), order=tuple(by), limit=k)
    return df.orderBy(*spec.sort_columns()).limit(k)


GID = "_gid"


def summarise_many(
    df: DataFrame, specs: Sequence[Summary]
) -> tuple[DataFrame, dict[str, Callable[[DataFrame], DataFrame]]]:
    """All specs from one scan of ``df``.

    Returns the combined aggregate (one row per group of every spec,
    tagged by ``_gid``) and a function of it per spec.  The combined
    frame is small - the sum of the specs' group counts - so callers
    materialise it once (checkpoint or write) and derive every table
    from it without touching ``df`` again.
    """
    keys: list[str] = []
    for s in specs:
        for k in s.keys:
            if k not in keys:
                keys.append(k)
    # every distinct measure once; averages are rounded per spec later
    base: dict[tuple, str] = {}
    aggs = []
    for s in specs:
        for m in s.measures:
            if m.key not in base:
                base[m.key] = f"_m{len(base)}"
                value = m.expr() if m.exact else AGGS[m.agg](F.col(m.column) if m.column else None)
                aggs.append(value.alias(base[m.key]))
    sets = [[F.col(k) for k in s.keys] for s in specs]
    combined = df.groupingSets(sets, *keys).agg(F.grouping_id().alias(GID), *aggs)
    full = (1 << len(keys)) - 1
    gid_of = {}
    for s in specs:
        mask = 0
        for i, k in enumerate(keys):
            if k not in s.keys:
                mask |= 1 << (len(keys) - 1 - i)
        gid_of[s.name] = mask
    assert all(v <= full for v in gid_of.values())

    def table(frame: DataFrame, spec: Summary) -> DataFrame:
        cols = [F.col(k) for k in spec.keys]
        for m in spec.measures:
            v = F.col(base[m.key])
            if m.agg == "count":
                v = v.cast("bigint")
            cols.append((v if m.digits is None or m.exact else rnd(v, m.digits)).alias(m.name))
        return finish(frame.filter(F.col(GID) == gid_of[spec.name]).select(*cols), spec)

    return combined, {s.name: (lambda frame, s=s: table(frame, s)) for s in specs}
