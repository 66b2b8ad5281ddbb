"""Importance resampling of documents towards a target text.

Two generative models of hashed n-grams (of words and of word shapes,
each counted once per document): one of the target text, labelled good
documents, and one of all raw text.  A document's log weight is the sum
of its n-grams' log ratios, target over raw, relative to the ordinary
n-gram (see ``log_ratios``).  Gumbel top-k then samples without
replacement: the k documents with the largest log weight plus Gumbel
noise, which is hashed from the id and a seed.

k is the share of labelled documents that are target, times the number of
documents.  The threshold is exact: the k-th largest key, found by
counting key prefixes, eight at a time, over the narrow table of keys.

Defined results: a null text is the empty text and weighs 0 (log), as any
text without words; rows with the same key as the k-th stay, so repeated
rows stay or go together and the sample may exceed k by ties; null ids
are documents like others but have no label; without labelled rows, or
with no target among them, everything is kept; other columns are carried
untouched.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, stage, text_of
from tripflow.llm.hashing import hashed_texts, mix, seeded

#: Hash ranges (first bucket, buckets) of word 1-grams, word 2-grams, shape
#: 1-grams and shape 2-grams, so that the many rare pairs don't share
#: buckets with words.
RANGES = ((0, 160_000), (160_000, 64_000), (224_000, 8_000), (232_000, 24_000))
BUCKETS = 256_000
SMOOTHING = 0.5
SIGMA = 3.0
SEED = 17
#: Labelled documents that the target model is fitted to; of more, those
#: whose ids hash lowest.  Their ids (and nothing else) are broadcast.
MAX_TARGET = 50_000


def ngram_buckets(words: np.ndarray, at: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of each text: (bucket, text).

    1- and 2-grams of words, and of word shapes, where a shape also says
    whether its word repeats the word before."""
    with np.errstate(over="ignore"):
        same = at[1:] == at[:-1]
        again = np.zeros(len(words), np.uint64)
        again[1:] = (words[1:] == words[:-1]) & same
        shapes = seeded(shapes + again, 3)
        factor = np.uint64(0x9E3779B97F4A7C15)
        grams = [
            mix(words),
            mix(words[:-1] * factor + seeded(words[1:], 2))[same],
            shapes,
            mix(shapes[:-1] * factor + seeded(shapes[1:], 4))[same],
        ]
    bucket = np.concatenate([np.uint64(low) + g % np.uint64(n) for g, (low, n) in zip(grams, RANGES, strict=True)])
    bucket = bucket.astype(np.int64)
    text = np.concatenate([at, at[1:][same]] * 2)
    both = np.unique(text * BUCKETS + bucket)
    return both % BUCKETS, both // BUCKETS


def _counts(df: DataFrame) -> np.ndarray:
    """Texts holding each bucket: of the target, and of all raw text.

    ``df``: text, is_target.  One row per bucket reaches the driver."""
    out = T.StructType([T.StructField("bucket", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in "ab")])

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            target = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for first, n, words, at, shapes in hashed_texts(batch.column(0), shapes=True):
                bucket, at = ngram_buckets(words, at, shapes)
                np.add.at(total[1], bucket, 1)
                if target[first : first + n].any():
                    np.add.at(total[0], bucket[target[at + first]], 1)
        used = np.flatnonzero(total[1])
        for i in range(0, len(used), 65_536):
            part = used[i : i + 65_536]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), *(pa.array(x[part]) for x in total)], out.fieldNames()
            )

    found = df.mapInArrow(count, out).groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toPandas()
    total = np.zeros((2, BUCKETS), np.int64)
    for i, c in enumerate("ab"):
        total[i][found["bucket"].to_numpy(int)] = found[c].to_numpy(np.int64)
    return total


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Per bucket, the log of the target model over the raw model.

    Both are taken relative to the ordinary n-gram: the ratio that halves
    the raw mass counts as 1, so text made of what both hold alike weighs
    0 at any length.  A ratio within SIGMA standard errors of 1, or over
    1, counts as 1."""
    target, raw = (x.astype(float) for x in counts)
    if not target.any():
        return np.zeros(len(raw))
    share = target / np.maximum(raw, 1.0)
    order = np.argsort(share, kind="stable")
    mass = np.cumsum(raw[order])
    usual = share[order][np.searchsorted(mass, mass[-1] / 2)]
    expected = raw * usual
    error = np.sqrt(np.maximum(expected * (1.0 - usual), 1e-9))
    ratio = np.log((target + SMOOTHING) / (expected + SMOOTHING))
    return np.where(expected - target > SIGMA * error, ratio, 0.0)


def log_weights(df: DataFrame, id_col: str, text_col: str, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """id, log_weight, and a long that sorts as log weight plus Gumbel noise."""
    spark = df.sparkSession
    table = spark.sparkContext.broadcast(ratios.astype(np.float32))  # BUCKETS floats
    rows = df.select(
        col(id_col).alias("id"), text_of(text_col).alias("text"), F.xxhash64(F.lit(seed), col(id_col)).alias("noise")
    )
    out = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("log_weight", T.DoubleType()),
            T.StructField("order", T.LongType()),
        ]
    )

    def weigh(batches):
        ratio = table.value.astype(float)
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for first, n, words, at, shapes in hashed_texts(batch.column(1), shapes=True):
                bucket, at = ngram_buckets(words, at, shapes)
                weight[first : first + n] = np.bincount(at, ratio[bucket], minlength=n)
            noise = batch.column(2).to_numpy().view(np.uint64)
            uniform = ((mix(noise) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            bits = (weight - np.log(-np.log(uniform)) + 0.0).view(np.int64)
            order = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight), pa.array(order)], out.fieldNames())

    return rows.mapInArrow(weigh, out)


def kth_largest(df: DataFrame, column: str, k: int) -> int:
    """The k-th largest value (1 <= k <= rows) of a long column, exactly:
    four rounds fix 16 bits each by counting rows under each prefix, so at
    most 65,536 counts reach the driver in a round."""
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        rows = df if prefix is None else df.where(F.shiftright(column, shift + 16) == F.lit(prefix))
        found = rows.groupBy(F.shiftright(column, shift).alias("p")).count().collect()
        for p, n in sorted(((r["p"], r["count"]) for r in found), reverse=True):
            if n >= left:
                prefix = p
                break
            left -= n
    return prefix


def resample(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, target: str, seed: int = SEED
) -> DataFrame:
    """One row per input row: the id column, log_weight, kept.

    target: a condition on the columns of ``labels`` that holds for the
    target text.  An id counts as target if all its labels say so.
    """
    known = (
        labels.where(col(id_col).isNotNull())
        .groupBy(col(id_col).alias("id"))
        .agg(F.min(F.coalesce(F.expr(target), F.lit(False))).alias("is_target"))
    )
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    chosen = known.where("is_target").orderBy(F.xxhash64("id"), "id").limit(MAX_TARGET)
    marked = rows.join(F.broadcast(chosen), "id", "left").select(
        "text", F.coalesce("is_target", F.lit(False)).alias("is_target")
    )
    ratios = log_ratios(_counts(marked))
    weighed = stage(log_weights(df, id_col, text_col, ratios, seed), "log-weights")
    n = weighed.count()
    chosen = weighed.select("id").join(known, "id").agg(F.count("*"), F.sum(F.col("is_target").cast("long"))).first()
    k = n if not chosen[0] or not chosen[1] else max(1, math.floor(n * chosen[1] / chosen[0] + 0.5))
    if k >= n:
        kept = F.lit(True)
    else:
        kept = F.col("order") >= F.lit(kth_largest(weighed, "order", k))
    return weighed.select(F.col("id").alias(id_col), "log_weight", kept.alias("kept"))
