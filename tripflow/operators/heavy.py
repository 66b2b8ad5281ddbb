"""The k largest groups of very many, without aggregating all of them.

A group-by for a top-k moves every group through the shuffle, though a few
are wanted.  Here a first pass keeps a bounded sketch of frequent keys in
each task (``approx_top_k``, which tracks a fixed number of items) and
merges them; a second pass aggregates, exactly, the rows of the candidates
only.  A key that the sketch doesn't hold occurs at most ``ERROR / size`` of
all rows' times.  So if the k-th candidate's exact count is above that, the
result is the whole answer; if the bound doesn't separate it, all groups
are aggregated as usual.

Keys are tracked by a 64-bit hash: keys that share one are candidates
together and are told apart by the exact pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.expr import row_hash
from tripflow.operators.summarise import Summary, finish, summarise

#: Items that a sketch tracks: its size, and the bound on what is broadcast.
TRACKED = 10_000
#: Of a sketch with ``size`` slots, a share of rows that a key it doesn't hold
#: may have is at most ERROR / size (the frequent items sketch's own bound).
ERROR = 3.5


def _slots(tracked: int) -> int:
    """Slots of a sketch that tracks so many items: a power of two, three
    quarters of which may be filled."""
    slots = 8
    while slots * 3 < tracked * 4:
        slots *= 2
    return slots


def candidates(df: DataFrame, keys: tuple[str, ...], tracked: int = TRACKED) -> tuple[DataFrame, float]:
    """Hashes of the keys that may be frequent (one column, at most
    ``tracked`` rows), and the count that any other key is at most of."""
    hashed = df.select(row_hash(df.schema, keys).alias("h"))
    found = hashed.agg(F.expr(f"approx_top_k(h, {tracked}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    rows = [(r["item"],) for r in found["top"] or []]
    return df.sparkSession.createDataFrame(rows, "h long"), ERROR / _slots(tracked) * found["n"]


def top_groups(df: DataFrame, spec: Summary, count: str, tracked: int = TRACKED) -> DataFrame:
    """The summary ``spec``, whose rows are cut at ``spec.limit`` in order of
    the measure ``count`` (a count of rows, falling), from its candidates'
    rows alone where the sketch's bound allows it."""
    if spec.limit is None or not spec.order or spec.order[0] != (count, False):
        raise ValueError(f"{spec.name}: needs a limit, and {count} falling as its first order")
    if not any(m.name == count and m.agg == "count" for m in spec.measures):
        raise ValueError(f"{spec.name}: {count} is no count of rows")
    some, bound = candidates(df, spec.keys, tracked)
    kept = df.withColumn("_h", row_hash(df.schema, spec.keys)).join(F.broadcast(some), F.col("_h") == some["h"]).drop("_h", "h")
    top = summarise(kept, spec)
    rows = top.collect()  # at most spec.limit
    if len(rows) == spec.limit and rows[-1][count] > bound:
        return finish(df.sparkSession.createDataFrame(rows, top.schema), Summary(spec.name, spec.keys, (), order=spec.order, limit=spec.limit))
    return summarise(df, spec)
