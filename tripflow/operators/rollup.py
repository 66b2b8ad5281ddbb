"""Roll-ups: stored partial aggregates that summaries are derived from.

A ``RollUp`` holds, per group of a fine grain, mergeable states of the
measures that several summaries need.  The rows are read once per roll-up;
every summary whose keys are among the roll-up's keys then comes from its
few group rows, and states of new rows merge with stored ones, so a table
over a year is refreshed from one day's rows.

States of a column:

* count of its values,
* floating columns: the exact sum as two bigints, in units of 1e-4 and
  remainders of 1e-9, so that sums don't depend on partitions or on the
  order of merging (money has fewer places; values are rounded to 9).
  NaN, infinities and values from 1e11 on, which have no such parts, are
  summed apart as doubles;
* integers and decimals: the plain sum; min and max as they are.

The remainders of 9e13 rows fit in a bigint; a sum beyond its type raises
(ANSI mode) instead of wrapping.  Aggregates are plain hash aggregates
with map-side partials: a hot group collapses in each task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.expr import is_float_type, quoted, rnd
from tripflow.operators.summarise import Measure, Summary, finish

ROWS = "_rows"
FAR = 1e11


@dataclass(frozen=True)
class RollUp:
    """Group keys and the (agg, column) pairs kept for each group."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[tuple[str, str], ...] = ()

    @classmethod
    def serving(cls, name: str, keys: Sequence[str], summaries: Sequence[Summary]) -> RollUp:
        """The roll-up by ``keys`` that holds what ``summaries`` need."""
        missing = [s.name for s in summaries if not set(s.keys) <= set(keys)]
        if missing:
            raise ValueError(f"{name}: keys of {missing} are not among {tuple(keys)}")
        wanted = {(m.agg, m.column) for s in summaries for m in s.measures if m.agg != "count"}
        # an average needs what a sum does
        return cls(name, tuple(keys), tuple(sorted({("sum" if a == "avg" else a, c) for a, c in wanted})))


def _sql(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _state(agg: str, column: str, part: str) -> str:
    return f"_{agg}_{part}_{column}"


def _states(rollup: RollUp, schema: T.StructType) -> list[Column]:
    """The states of input rows."""
    out = [F.count(F.lit(1)).alias(ROWS)]
    for agg, column in rollup.measures:
        x = _sql(column)
        name = lambda part, a=agg, c=column: _state(a, c, part)
        if agg in ("min", "max"):
            out.append(F.expr(f"{agg}({x})").alias(name("value")))
            continue
        if agg != "sum":
            raise ValueError(f"no mergeable state for {agg!r}")
        out.append(F.expr(f"count({x})").alias(name("n")))
        if not is_float_type(schema[column].dataType):
            out.append(F.expr(f"sum({x})").alias(name("sum")))
            continue
        x = f"CAST({x} AS DOUBLE)"
        near, units = f"abs({x}) < {FAR!r}D", f"floor({x} * 10000D)"
        rest = f"floor(({x} - {units} / 10000D) * 1000000000D + 0.5D)"
        out += [
            F.expr(f"sum(CASE WHEN {near} THEN {units} END)").alias(name("units")),
            F.expr(f"sum(CASE WHEN {near} THEN {rest} END)").alias(name("rest")),
            F.expr(f"sum(CASE WHEN NOT {near} THEN {x} END)").alias(name("far")),
        ]
    return out


def partials(df: DataFrame, rollup: RollUp) -> DataFrame:
    """The roll-up of ``df``: one row per group, its keys and states."""
    return df.groupBy(*[quoted(k) for k in rollup.keys]).agg(*_states(rollup, df.schema))


def merge(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of any number of roll-ups (one after another in ``states``)
    merged by ``keys``, some or all of theirs."""
    held = [c for c in states.columns if c == ROWS or c.startswith(("_sum_", "_min_", "_max_"))]
    how = lambda c: c[1:4] if c.startswith(("_min_", "_max_")) else "sum"
    aggs = [F.expr(f"{how(c)}({_sql(c)})").alias(c) for c in held]
    return states.groupBy(*[quoted(k) for k in keys]).agg(*aggs)


def _value(m: Measure, columns: Sequence[str]) -> Column:
    """A measure from merged states."""
    if m.agg == "count":
        return F.coalesce(F.col(ROWS), F.lit(0)).cast("bigint")
    if m.agg in ("min", "max"):
        value = quoted(_state(m.agg, m.column, "value"))
        return rnd(value, m.digits) if m.digits is not None else value
    n = quoted(_state("sum", m.column, "n"))
    if _state("sum", m.column, "sum") in columns:
        total = quoted(_state("sum", m.column, "sum"))
        if m.agg == "sum":
            return F.round(total, m.digits).cast("double") if m.digits is not None else total
        return _shown(F.try_divide(total.cast("double"), n), m.digits)
    units, rest, far = (_sql(_state("sum", m.column, p)) for p in ("units", "rest", "far"))
    exact = F.expr(
        f"CAST({units} AS DECIMAL(20,0)) * 0.0001BD + CAST({rest} AS DECIMAL(20,0)) * 0.000000001BD"
    )
    plain = F.coalesce(exact.cast("double"), F.lit(0.0)) + F.expr(far)
    if m.agg == "sum":
        shown = F.round(exact, m.digits) if m.digits is not None else exact
        return F.when(F.expr(far).isNotNull(), plain).otherwise(shown.cast("double"))
    total = F.when(F.expr(far).isNotNull(), plain).otherwise(exact.cast("double"))
    return _shown(F.try_divide(total, n), m.digits)


def _shown(value: Column, digits: int | None) -> Column:
    return rnd(value, digits) if digits is not None else value


def derive(states: DataFrame, spec: Summary) -> DataFrame:
    """The summary ``spec`` from states whose grain has its keys."""
    merged = merge(states, spec.keys)
    cols = [quoted(k).alias(k) for k in spec.keys]
    cols += [_value(m, merged.columns).alias(m.name) for m in spec.measures]
    return finish(merged.select(*cols), spec)


def serving_rollup(rollups: Sequence[RollUp], spec: Summary) -> RollUp:
    """The first roll-up that ``spec`` can be derived from."""
    for r in rollups:
        held = {("avg", c) for a, c in r.measures if a == "sum"} | set(r.measures) | {("count", None)}
        if set(spec.keys) <= set(r.keys) and all((m.agg, m.column) in held or m.agg == "count" for m in spec.measures):
            return r
    raise ValueError(f"no roll-up serves {spec.name!r}")


def derive_all(states: Mapping[str, DataFrame], rollups: Sequence[RollUp], specs: Sequence[Summary]) -> dict[str, DataFrame]:
    """Every summary from the states (by roll-up name) that serve it."""
    return {s.name: derive(states[serving_rollup(rollups, s).name], s) for s in specs}
