"""Exact quantiles under many filters in one job: a nested rank index.

One aggregate counts every distinct value of a column once for each filter
(the conditional histogram).  Two coarser levels are sums of it: cells of
about 0.3 % of a value (by its logarithm), and a million equal slices of each
cell.  Going down, a running count over a level's cells finds the one that
holds a target's rank, and only that cell's slices, then that slice's
values, are ranked.  All of this is one query, whatever the number of
targets and filters; ranges needn't be known before.

Bounds: the upper level has at most some 540,000 cells, a cell at most
2**20 slices or so, and a slice spans a relative 3e-9, so no window ranks more
rows than that.  Repeated values collapse in each task before the shuffle
(a money column has some 100,000 distinct ones); a column of all different
values shuffles one narrow row for each.  Against
:mod:`tripflow.operators.quantile_select`, which shuffles bucket counts only
but needs a job per round, this is the better one for many targets on
columns of repeated values.

Rank, types, nulls and NaN are those of that module: the smallest value
whose cumulative count reaches ``max(1, ceil(p * n))``; integers and
decimals come back as decimals; nulls and NaN are ignored; infinities are
values.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.operators.quantile_select import _own

CELLS_PER_E = 368.0
SLICES = float(1 << 20)


@dataclass
class RankTarget:
    """The ``prob`` quantile of the rows that pass ``where``."""

    key: Hashable
    prob: float
    where: Column | None = field(default=None, compare=False)


def _cell(x: str) -> str:
    """The upper cell of a value: monotone, as the logarithm is."""
    d = f"CAST({x} AS DOUBLE)"
    size = f"CAST(floor(ln(abs({d})) * {CELLS_PER_E}D) AS BIGINT) + 1000000"
    return (
        f"CASE WHEN {d} = 0D THEN 0L WHEN {d} = double('inf') THEN 9000000L WHEN {d} = double('-inf') THEN -9000000L "
        f"WHEN {d} > 0D THEN {size} ELSE -({size}) END"
    )


def _slice(x: str, cell: str) -> str:
    """The slice of a value in its cell: for one cell a multiple of the
    value, cut to a whole number."""
    d = f"CAST({x} AS DOUBLE)"
    scale = f"exp((1000000 - abs({cell})) / {CELLS_PER_E}D) * {CELLS_PER_E * SLICES}D"
    return f"CASE WHEN abs({cell}) >= 9000000 OR {cell} = 0 THEN 0D ELSE floor(least({d} * ({scale}), 1e18D)) END"


def ranked_values(df: DataFrame, column: str, targets: Sequence[RankTarget]) -> dict[Hashable, object]:
    """The value of every target, None where no row passes its filter; one job."""
    targets = list(targets)
    if not targets:
        return {}
    wheres: list[Column | None] = []
    of_target = []
    for t in targets:
        same = [j for j, w in enumerate(wheres) if (w is None) == (t.where is None) and str(w) == str(t.where)]
        of_target.append(same[0] if same else len(wheres))
        if not same:
            wheres.append(t.where)
    x = _own(df, column)
    rows = df.select(
        F.expr(x).alias("x"),
        *[F.lit(True).alias(f"f{j}") if w is None else F.coalesce(w, F.lit(False)).alias(f"f{j}") for j, w in enumerate(wheres)],
    )
    rows = rows.where("x IS NOT NULL AND NOT isnan(x)" if x.endswith("AS DOUBLE)") else "x IS NOT NULL")
    counts = [f"c{j}" for j in range(len(wheres))]
    sums = [F.sum(c).alias(c) for c in counts]
    values = rows.groupBy("x").agg(*[F.expr(f"count_if(f{j})").alias(c) for j, c in enumerate(counts)])
    # never null, so that no join below adds a filter of its own: one exchange
    # of the values serves all three levels
    values = values.withColumn("cell", F.coalesce(F.expr(_cell("x")), F.lit(0).cast("bigint")))
    values = values.withColumn("slice", F.coalesce(F.expr(_slice("x", "cell")), F.lit(0.0)))
    slices = values.groupBy("cell", "slice").agg(*sums)
    cells = slices.groupBy("cell").agg(*sums)

    # the cell of each target: at most one row a target
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(0))
    running = cells.select(
        "cell",
        *counts,
        *[F.sum(c).over(upto).alias(f"upto_{c}") for c in counts],
        *[F.sum(c).over(every).alias(f"all_{c}") for c in counts],
    )
    found = ", ".join(
        f"named_struct('t', {i}, 'k', greatest(1L, all_c{j} - CAST(floor(all_c{j} - all_c{j} * {float(t.prob)!r}D) AS BIGINT)), "
        f"'below', upto_c{j} - c{j}, 'upto', upto_c{j})"
        for i, (t, j) in enumerate(zip(targets, of_target, strict=True))
    )
    inside = "below < k AND k <= upto"
    at = running.select("cell", F.expr(f"inline(array({found}))")).where(inside).select("t", "k", "below", "cell")

    own = F.expr("CASE t " + " ".join(f"WHEN {i} THEN c{j}" for i, j in enumerate(of_target)) + " END")

    def descend(level: DataFrame, at: DataFrame, keys: list[str], by: str) -> DataFrame:
        """The rows of ``level`` in the targets' cells that hold their ranks."""
        ranked = level.join(at.hint("merge"), keys).withColumn("c", own)
        order = Window.partitionBy("t").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = ranked.withColumn("upto", F.col("below") + F.sum("c").over(order)).withColumn("below", F.col("upto") - F.col("c"))
        return ranked.where(inside)

    at = descend(slices, at, ["cell"], "slice").select("t", "k", "below", "cell", "slice")
    found_rows = descend(values, at, ["cell", "slice"], "x").select("t", "x").collect()  # one row a target
    out: dict[Hashable, object] = {t.key: None for t in targets}
    for r in found_rows:
        out[targets[r["t"]].key] = r["x"]
    return out
