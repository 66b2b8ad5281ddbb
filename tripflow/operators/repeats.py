"""Distinct rows with their copies, where most rows have none.

Grouping whole rows keeps each row of a task's input in a hash map and then
moves it: a map larger than its task's memory is spilled.  Here hashes of
rows are counted first.  A row whose hash occurs once has no copy and stays
where it was read; only the others are grouped, column by column.

1. Hashes go to their reducers as they are (8 bytes a row, no map in the
   reading task).  Those so frequent that they would fill one reducer are
   known before from a sample, and are dealt by where they were read.
2. Hashes found twice set a bit of a bitmap of at most FILTER_BITS bits, sent
   to the tasks (twice its size, 16 MB).
3. Rows whose bit isn't set are given as they are, with one copy.  All others
   (rows with copies, and a few whose bit is another's) are grouped, with
   partial aggregation, so that a hot row collapses in its tasks.

Equal rows have equal hashes, so no copy is missed; rows that share a hash,
or a bit, are told apart by the grouping.  If most rows have copies, most
bits are set and nearly all rows are grouped, as without this.  The rows are
read four times, so they should be cheap to read, and read alike each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.expr import is_float_type, quoted, row_hash
from tripflow.operators.rules import COPIES, with_copies

FILTER_BITS = 1 << 26
BLOCK_BITS = 1 << 15  # of a bitmap of Spark's bitmap functions
WORD_BITS = 32
#: Share of the rows looked at for hot hashes: those seen HOT_SEEN times, HOT_KEPT
#: at most.  It decides how rows travel, never what comes out.
HOT_SHARE, HOT_SEEN, HOT_KEPT = 0.01, 10, 1000
PRINT = "_print"

_ATOMS = (
    T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def plain_columns(schema: T.StructType) -> bool:
    """Whether all columns are of types whose equal values hash alike (a
    string with a collation may equal another of other bytes)."""
    return all(isinstance(f.dataType, _ATOMS) or f.dataType.simpleString() == "string" for f in schema)


def _prints(df: DataFrame) -> DataFrame:
    return df.select(row_hash(df.schema, df.columns).alias(PRINT))


def _hot(df: DataFrame) -> list[int]:
    """Hashes that many rows share, as far as a sample shows; HOT_KEPT at most."""
    seen = _prints(df.sample(False, HOT_SHARE, seed=17)).groupBy(PRINT).agg(F.count(F.lit(1)).alias("n"))
    top = seen.where(F.col("n") >= HOT_SEEN).orderBy(F.desc("n"), PRINT).limit(HOT_KEPT).collect()
    return [r[PRINT] for r in top]


def _position(print_: Column) -> Column:
    return F.pmod(print_, F.lit(FILTER_BITS))


def repeat_filter(df: DataFrame) -> DataFrame:
    """Bits of the hashes that several rows of ``df`` share: block, words."""
    prints, hot = _prints(df), _hot(df)
    keys = [PRINT]
    if hot:  # a projection: a filter or join would be pushed below, and hash again
        keys.append("_deal")
        prints = prints.withColumn("_deal", F.when(F.col(PRINT).isin(hot), F.spark_partition_id()).otherwise(F.lit(-1)))
    same = prints.repartition(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    twice = same.where("n > 1").select(PRINT)
    if hot:
        twice = twice.unionAll(df.sparkSession.createDataFrame([(h,) for h in hot], f"{PRINT} long"))
    at = _position(F.col(PRINT))
    bitmaps = (
        twice.select((at / BLOCK_BITS).cast("int").alias("block"), (at % BLOCK_BITS).alias("bit"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    # a word's four bytes, the lowest bits in the first
    digits = ", ".join(f"hex(substring(bitmap, 4 * w + {k}, 1))" for k in (4, 3, 2, 1))
    word = f"CAST(conv(concat({digits}), 16, 10) AS BIGINT)"
    words = F.expr(f"transform(sequence(0, {BLOCK_BITS // WORD_BITS - 1}), w -> {word})")
    return bitmaps.select("block", words.alias("words"))


def distinct_with_copies(df: DataFrame) -> DataFrame:
    """What :func:`with_copies` gives."""
    if not plain_columns(df.schema) or PRINT in df.columns:
        return with_copies(df)
    hashed = df.withColumn(PRINT, row_hash(df.schema, df.columns))
    repeats = repeat_filter(df).withColumnRenamed("block", "_block")
    at = _position(F.col(PRINT))
    placed = hashed.select("*", (at / BLOCK_BITS).cast("int").alias("_block"), (at % BLOCK_BITS).cast("int").alias("_bit"))
    marked = placed.join(F.broadcast(repeats), "_block", "left").withColumn(
        "_set",
        F.expr(f"coalesce(bit_get(element_at(words, CAST(_bit DIV {WORD_BITS} AS INT) + 1), CAST(_bit % {WORD_BITS} AS INT)), 0) = 1"),
    )
    # grouping gives 0.0 for -0.0
    alone = [
        (quoted(f.name) + F.lit(0.0).cast(f.dataType)).alias(f.name) if is_float_type(f.dataType) else quoted(f.name)
        for f in df.schema
    ]
    single = marked.where("NOT _set").select(*alone, F.lit(1).cast("bigint").alias(COPIES))
    return single.unionAll(with_copies(marked.where("_set").select(*map(quoted, df.columns))))
