"""Bronze -> silver: dedupe, required columns, range and time rules,
self-tuned IQR outlier removal, derived columns.

Plan:

1. ``tag``: whole-row dedupe that keeps each distinct row's multiplicity, and
   tags it with the first cleaning step it fails.  Hashes of rows are
   shuffled; of the rows only those whose hash occurs again
   (``operators/repeats.py``).  Written once to the shared scratch folder,
   unsorted.
2. ``tune``: quartiles for all candidate multipliers, read from the
   staged rows that pass every step (the tag is a pushed filter, and only
   it and the three IQR columns are read).
3. ``write``: staged clean rows -> outlier bounds (literals) -> derived
   columns -> silver.
4. The funnel and the rejected rows come from the staged table (two
   small columns), not from another dedupe.

Staging in shared storage cuts the lineage: a lost executor costs a
retry of its own tasks, never a second dedupe of bronze.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.columns import TRIP, TripColumns
from tripflow.functions.features import add_features
from tripflow.operators.outliers import CANDIDATE_COLUMNS, Bounds, Tuning, bounds_table, tuned_iqr_filter
from tripflow.operators.profile import duplicate_stats_from_copies
from tripflow.operators.quantile_select import DEFAULT_ACCURACY
from tripflow.operators.repeats import distinct_with_copies
from tripflow.operators.rules import (
    COPIES,
    TAG,
    Rule,
    Step,
    funnel_from_tags,
    rejects_from_tags,
    tag_rows,
    with_tags,
)
from tripflow.plans import specs
from tripflow.session import scratch_path
from tripflow.sources.io import committed, local_frame, read_layer, write_layer
from tripflow.sources.snapshots import remove


@dataclass
class SilverBuild:
    silver: DataFrame
    path: str | None
    staged_path: str | None
    staged: DataFrame | None  # None once it is discarded
    steps: list[Step]
    tuning: Tuning
    multiplier: float

    @property
    def candidates(self) -> DataFrame:
        return self.tuning.table

    @property
    def bounds(self) -> DataFrame:
        return bounds_table(self.silver.sparkSession, self.tuning.bounds[self.multiplier])

    @property
    def passing(self) -> DataFrame:
        """Distinct rows that pass every step before outlier removal."""
        return passing(self._staged())

    def _staged(self) -> DataFrame:
        if self.staged is None:
            raise ValueError(f"{self.staged_path}: the staged table was discarded")
        return self.staged

    def _retagged(self) -> DataFrame:
        staged = self._staged()
        outlier = self.steps[-1]
        tag = F.when((F.col(TAG) == 0) & ~outlier.passes(), F.lit(len(self.steps))).otherwise(F.col(TAG))
        return staged.withColumn(TAG, tag)

    def duplicate_stats(self) -> DataFrame:
        """Whole-row duplicate figures of bronze from the staged copy
        counts (reads one column; no second dedupe shuffle)."""
        return duplicate_stats_from_copies(self._staged(), COPIES)

    def details(self) -> dict:
        """What :func:`restore_silver` needs besides the tables."""
        bounds = {str(m): [[b.column, b.q1, b.q3] for b in bs] for m, bs in self.tuning.bounds.items()}
        return {
            "staged_path": self.staged_path,
            "multiplier": self.multiplier,
            "bounds": bounds,
            "candidates": [list(r) for r in self.tuning.table.collect()],  # one row a multiplier
        }

    def discard(self) -> None:
        """Remove the staged table; funnel, rejects and duplicate figures
        can't be read from this build afterwards."""
        if self.staged_path:
            remove(self.silver.sparkSession, self.staged_path)
            self.staged = None

    def funnel(self) -> DataFrame:
        """(step, name, rows_in, rows_out, removed) for read, dedupe, each step."""
        return funnel_from_tags(self._retagged(), self.steps)

    def rejects(self) -> DataFrame:
        """Removed rows with ``reject_step`` and ``copies``."""
        return rejects_from_tags(self._retagged(), self.steps)


def stage_tagged(bronze: DataFrame, steps: Sequence[Step], path: str) -> DataFrame:
    """Distinct rows with multiplicity and first failing step, written once."""
    tagged = with_tags(distinct_with_copies(bronze), steps)
    tagged.write.parquet(path)
    return bronze.sparkSession.read.schema(tagged.schema).parquet(path)


def passing(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col(TAG) == 0).drop(TAG, COPIES)


def build_silver(
    bronze: DataFrame,
    target: str | None = None,
    c: TripColumns = TRIP,
    multipliers: Sequence[float] = specs.IQR_MULTIPLIERS,
    min_retain_ratio: float | None = None,
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
    partition_by: Sequence[str] = (),
    year: int = specs.TARGET_YEAR,
    month: int = specs.TARGET_MONTH,
) -> SilverBuild:
    """Build silver for one month from checked bronze rows (none is fine)."""
    spark = bronze.sparkSession
    specs.check_trips(bronze, c)
    steps = specs.cleaning_steps(bronze, c, year, month)
    staged_path = scratch_path(spark, "silver-staged")
    staged = stage_tagged(bronze, steps, staged_path)
    return finish_silver(
        passing(staged), staged, staged_path, steps, target, c, multipliers, min_retain_ratio, method, accuracy, partition_by
    )


def finish_silver(
    sound: DataFrame,
    staged: DataFrame,
    staged_path: str | None,
    steps: list[Step],
    target: str | None,
    c: TripColumns = TRIP,
    multipliers: Sequence[float] = specs.IQR_MULTIPLIERS,
    min_retain_ratio: float | None = None,
    method: str = "exact",
    accuracy: int = DEFAULT_ACCURACY,
    partition_by: Sequence[str] = (),
) -> SilverBuild:
    """Silver from the distinct rows that pass every step (``sound``); ``staged``
    are all distinct rows with their copies and tags."""
    spark = sound.sparkSession
    threshold = specs.min_retain_ratio() if min_retain_ratio is None else min_retain_ratio
    kept, tuning, chosen = tuned_iqr_filter(sound, specs.iqr_columns(c), multipliers, threshold, method, accuracy)
    outlier_rules = tuple(Rule(f"iqr {b.column}", b.keep(), "outlier") for b in tuning.bounds[chosen])
    all_steps = [*steps, Step("outliers", outlier_rules)]  # as restore_silver has them
    silver = add_features(kept, c)
    if target is not None:
        write_layer(silver, target, partition_by=partition_by)
        silver = read_layer(spark, target)
    return SilverBuild(silver, target, staged_path, staged, all_steps, tuning, chosen)


def restore_silver(
    bronze: DataFrame,
    details: dict,
    target: str,
    c: TripColumns = TRIP,
    year: int = specs.TARGET_YEAR,
    month: int = specs.TARGET_MONTH,
) -> SilverBuild:
    """The build that left ``details`` and the silver layer ``target``; runs no
    job.  Its funnel, rejects and duplicate figures need the staged table."""
    spark = bronze.sparkSession
    steps = specs.cleaning_steps(bronze, c, year, month)
    bounds = {float(m): [Bounds(col, q1, q3, float(m)) for col, q1, q3 in bs] for m, bs in details["bounds"].items()}
    schema = T._parse_datatype_string(CANDIDATE_COLUMNS)
    table = local_frame(spark, details["candidates"], schema)
    chosen = float(details["multiplier"])
    rules = tuple(Rule(f"iqr {b.column}", b.keep(), "outlier") for b in bounds[chosen])
    path = details["staged_path"]
    staged = spark.read.schema(tag_rows(bronze, steps).schema).parquet(path) if committed(spark, path) else None
    return SilverBuild(
        read_layer(spark, target), target, path, staged, [*steps, Step("outliers", rules)],
        Tuning(table, bounds, tuple(bounds)), chosen,
    )
