"""Row rules: declarative predicates, dedupe, the cleaning funnel, rejects.

A ``Rule`` is a named predicate that *keeps* a row when true.  A ``Step``
is an ordered group of rules (e.g. "required", "range", "time").  Rules
compose into one ``filter`` so Catalyst can push every comparison into
the Parquet scan, including through a whole-row dedupe.

The funnel counts rows removed by each step without one job per step:
each distinct row is tagged with the *first* step it fails, and a single
aggregate counts tags.  Because the filters commute with whole-row
dedupe, the counts equal sequential counting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expr import present, quoted

COPIES = "_copies"
TAG = "_reject_step"


@dataclass(frozen=True)
class Rule:
    """Keep rows where ``keep`` is true; null counts as a failure."""

    name: str
    keep: Column = field(compare=False)
    kind: str = "rule"


@dataclass(frozen=True)
class Step:
    name: str
    rules: tuple[Rule, ...]

    def passes(self) -> Column:
        return conjunction(self.rules)


def conjunction(rules: Sequence[Rule]) -> Column:
    """AND of all rules with null treated as false (for tagging)."""
    if not rules:
        return F.lit(True)
    return F.coalesce(reduce(lambda a, b: a & b, [r.keep for r in rules]), F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One ``filter`` for all rules.

    A plain AND (a filter already drops null), so Catalyst splits it into
    conjuncts and pushes each comparison into the Parquet reader.
    """
    if not rules:
        return df
    return df.filter(reduce(lambda a, b: a & b, [r.keep for r in rules]))


def required_rules(df: DataFrame, columns: Sequence[str]) -> tuple[Rule, ...]:
    """Not-null (and not-NaN for floating columns): what ``dropna(subset)`` keeps."""
    return tuple(Rule(f"required {c}", present(df, c), "null") for c in columns)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null, or NaN, in any of ``columns``."""
    return apply_rules(df, required_rules(df, columns))


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows (all columns unless ``subset`` is given).

    Planned as a hash aggregate with a map-side partial phase, so a row
    repeated millions of times is collapsed inside each map task before
    the shuffle; a hot group of copies cannot pile up in one reducer.
    With ``subset`` Spark keeps an arbitrary row per key.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their multiplicity in ``_copies`` (one shuffle)."""
    return df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias(COPIES))


def first_failing_step(steps: Sequence[Step]) -> Column:
    """1-based index of the first failing step, 0 when every step passes."""
    expr = None
    for i, step in enumerate(steps, start=1):
        cond = ~step.passes()
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.lit(0) if expr is None else expr.otherwise(F.lit(0))


def tag_rows(df: DataFrame, steps: Sequence[Step], dedupe_rows: bool = True) -> DataFrame:
    """Distinct rows (or all rows) with ``_copies`` and ``_reject_step``."""
    base = with_copies(df) if dedupe_rows else df.withColumn(COPIES, F.lit(1).cast("bigint"))
    return with_tags(base, steps)


def with_tags(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Rows with the first step that each fails in ``_reject_step``."""
    return df.withColumn(TAG, first_failing_step(steps))


FUNNEL_SCHEMA = "step int, name string, rows_in bigint, rows_out bigint, removed bigint"


def funnel_from_tags(tagged: DataFrame, steps: Sequence[Step], dedupe_rows: bool = True) -> DataFrame:
    """The funnel from tagged rows: one aggregate, then a tiny reshaping.

    Rows: 0 ``read``, 1 ``dedupe`` (when deduping), then one per step.
    """
    tag = F.col(TAG)
    sums = tagged.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).cast("bigint").alias("raw"),
        F.count(F.lit(1)).alias("distinct"),
        *[F.count_if(tag == i).alias(f"r{i}") for i in range(1, len(steps) + 1)],
    )
    rows = []
    raw, distinct = F.col("raw"), F.col("distinct")

    def row(i: int, name: str, rows_in: Column, rows_out: Column) -> Column:
        return F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("name"),
            rows_in.cast("bigint").alias("rows_in"),
            rows_out.cast("bigint").alias("rows_out"),
            (rows_in - rows_out).cast("bigint").alias("removed"),
        )

    rows.append(row(0, "read", raw, raw))
    first = 1
    current = raw
    if dedupe_rows:
        rows.append(row(1, "dedupe", raw, distinct))
        first = 2
        current = distinct
    for i, step in enumerate(steps, start=1):
        after = current - F.col(f"r{i}")
        rows.append(row(first + i - 1, step.name, current, after))
        current = after
    return sums.select(F.inline(F.array(*rows)))


def funnel(df: DataFrame, steps: Sequence[Step], dedupe_rows: bool = True) -> DataFrame:
    """Rows in / out / removed per cleaning step, in one pass over ``df``."""
    return funnel_from_tags(tag_rows(df, steps, dedupe_rows), steps, dedupe_rows)


def rejects_from_tags(tagged: DataFrame, steps: Sequence[Step], dedupe_rows: bool = True) -> DataFrame:
    """Removed rows with the step that removed them.

    Every raw row is either kept, removed as an extra copy (step
    ``dedupe``, ``copies`` = multiplicity - 1) or removed by the first
    step it fails (``copies`` = 1).  Summing ``copies`` per step gives the
    funnel's ``removed``.
    """
    names = F.element_at(F.array(*[F.lit(s.name) for s in steps]), F.col(TAG))
    data_cols = [quoted(c) for c in tagged.columns if c not in (COPIES, TAG)]
    entries = [
        F.when(F.col(TAG) > 0, F.struct(names.alias("reject_step"), F.lit(1).cast("bigint").alias("copies")))
    ]
    if dedupe_rows:
        entries.insert(
            0,
            F.when(
                F.col(COPIES) > 1,
                F.struct(F.lit("dedupe").alias("reject_step"), (F.col(COPIES) - 1).alias("copies")),
            ),
        )
    return (
        tagged.filter((F.col(TAG) > 0) | (F.col(COPIES) > 1))
        .select(*data_cols, F.explode(F.array_compact(F.array(*entries))).alias("_r"))
        .select(*data_cols, "_r.reject_step", "_r.copies")
    )


def quarantine(df: DataFrame, steps: Sequence[Step], dedupe_rows: bool = True) -> DataFrame:
    """Rows the steps remove, tagged with ``reject_step`` and ``copies``."""
    return rejects_from_tags(tag_rows(df, steps, dedupe_rows), steps, dedupe_rows)


def clean(df: DataFrame, steps: Sequence[Step], dedupe_rows: bool = True) -> DataFrame:
    """Dedupe, then keep rows passing every step (filters pushed to the scan)."""
    out = dedupe(df) if dedupe_rows else df
    return apply_rules(out, [r for s in steps for r in s.rules])
