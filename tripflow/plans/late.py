"""Late files: a month that arrives in parts.

Each part of bronze is made distinct and tagged by itself, and kept as a
layer of its own beside a Bloom filter of its rows' fingerprints.  A row
of a later part that no earlier filter finds is new; the few others are
compared, column by column, with the earlier rows of the same fingerprint.
So a late file costs a shuffle of its own rows and a look at the filters,
not a dedupe of the month.  A row that was there already is kept as a count
of more copies.

Silver is then tuned and written from the parts' new rows, which are the
month's distinct rows: the same as from the whole month in one go.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.columns import TRIP, TripColumns
from tripflow.functions.expr import quoted, row_hash
from tripflow.operators.bloom import blocks_for, bloom_table, might_hold
from tripflow.operators.rules import COPIES, TAG, tag_rows
from tripflow.plans import specs
from tripflow.plans.silver import SilverBuild, finish_silver
from tripflow.session import scratch_path
from tripflow.sources.io import read_layer, write_layer
from tripflow.sources.layout import Layout
from tripflow.sources.snapshots import current_version, names_in

PRINT, AGAIN, NUM = "_fingerprint", "_again", "_num"


@dataclass(frozen=True)
class Part:
    number: int
    new: int  # distinct rows that no earlier part has
    again: int  # distinct rows that an earlier part has
    compared: int  # rows that a filter found, and were compared


def parts(spark: SparkSession, layout: Layout) -> list[str]:
    """Folders of the parts that are whole, in the order they came."""
    names = [n for n in names_in(spark, layout.parts) if n.startswith("part-")]
    return [f"{layout.parts}/{n}" for n in names if current_version(spark, f"{layout.parts}/{n}/rows")]


def _same_row(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[f"`{c}`"].eqNullSafe(b[f"`{c}`"]) for c in columns])


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def add_part(
    rows: DataFrame,
    layout: Layout,
    c: TripColumns = TRIP,
    year: int = specs.TARGET_YEAR,
    month: int = specs.TARGET_MONTH,
) -> Part:
    """Take in a part of the month's bronze rows."""
    spark, steps = rows.sparkSession, specs.cleaning_steps(specs.check_trips(rows, c), c, year, month)
    tagged = tag_rows(rows, steps).withColumn(PRINT, row_hash(rows.schema, rows.columns))
    own = _staged(tagged.withColumn(NUM, F.monotonically_increasing_id()), "late-rows")
    earlier = parts(spark, layout)
    again, compared = None, 0
    if earlier:
        keys = own.select(F.col(PRINT).alias("key")).distinct()
        found = []
        for folder in earlier:
            bloom = read_layer(spark, f"{folder}/bloom")
            blocks = (bloom.agg(F.max("blocks")).first()[0]) or 1
            found.append(might_hold(keys, bloom, blocks))
        maybe = _staged(reduce(DataFrame.union, found).distinct().withColumnRenamed("key", PRINT), "late-candidates")
        compared = own.join(maybe, PRINT, "left_semi").count()
        old = reduce(DataFrame.unionByName, [read_layer(spark, f"{f}/rows") for f in earlier])
        old = old.where(~F.col(AGAIN)).select(PRINT, *map(quoted, rows.columns)).join(maybe, PRINT, "left_semi")
        suspects = own.join(maybe, PRINT, "left_semi")
        same = (suspects[PRINT] == old[PRINT]) & _same_row(suspects, old, rows.columns)
        again = suspects.join(old, same, "left_semi").select(NUM)
    marked = own.withColumn(AGAIN, F.lit(False))
    if again is not None:
        flags = _staged(again.select(F.col(NUM).alias("_held")), "late-again")
        marked = own.join(flags, own[NUM] == flags["_held"], "left").withColumn(AGAIN, F.col("_held").isNotNull()).drop("_held")
    marked = marked.drop(NUM)
    number = len(earlier)
    folder = f"{layout.parts}/part-{number:06d}"
    staged = _staged(marked, "late-part")
    counts = staged.agg(F.count_if(~F.col(AGAIN)).alias("new"), F.count_if(AGAIN).alias("again")).first()
    # the filter first: a part counts from when its rows are there
    write_layer(bloom_table(staged.where(~F.col(AGAIN)).select(PRINT), blocks_for(counts["new"])), f"{folder}/bloom")
    write_layer(staged, f"{folder}/rows")
    return Part(number, counts["new"], counts["again"], compared)


def month_rows(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """The month's distinct rows: with ``_copies`` over all parts, and as
    they stand in the parts (copies of the first part only, but no join)."""
    every = reduce(DataFrame.unionByName, [read_layer(spark, f"{f}/rows") for f in parts(spark, layout)])
    new = every.where(~F.col(AGAIN)).drop(AGAIN)
    data = [x for x in new.columns if x not in (COPIES, TAG, PRINT)]
    more = every.where(AGAIN).groupBy(PRINT, *map(quoted, data)).agg(F.sum(COPIES).alias("_more"))
    same = (new[PRINT] == more[PRINT]) & _same_row(new, more, data)
    copies = (F.col(COPIES) + F.coalesce("_more", F.lit(0))).alias(COPIES)
    counted = new.join(more, same, "left").select(*[new[f"`{x}`"] for x in data], copies, TAG)
    return counted, new.drop(PRINT)


def build_silver_from_parts(
    spark: SparkSession,
    layout: Layout,
    c: TripColumns = TRIP,
    year: int = specs.TARGET_YEAR,
    month: int = specs.TARGET_MONTH,
) -> SilverBuild:
    """Silver of all parts taken in so far; no dedupe."""
    counted, plain = month_rows(spark, layout)
    data = plain.drop(COPIES, TAG)
    steps = specs.cleaning_steps(data, c, year, month)
    return finish_silver(plain.where(F.col(TAG) == 0).drop(COPIES, TAG), counted, None, steps, layout.silver, c)
