"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; all but the
last return the columns of ``documents``.

1. quality: importance resampling towards labelled good documents; what it
   rejects goes.
2. lines: boilerplate lines of a source go; ``n_chars`` follows the text.
3. near_duplicates: one document of each class stays.
4. mix: documents come as often as their rates say (0 times and more).
   The good domain is the anchor and keeps its tokens.
5. encode: ids of each text (rows of equal ids, from the mix, included).
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripflow.llm import bpe_codec, line_dedup, minhash, mixing, resample  # noqa: E402
from tripflow.llm.common import stage, table  # noqa: E402
from tripflow.llm.queries import BYTE_BPE, DOMAIN, GOOD, MIX  # noqa: E402

# The stages run as one program, whose rows SQL can't express (models,
# hashes and the tokenizer); tests hold them against plain versions.
ORACLE_SQL = None


def _without_rejected(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` less the ids of which no row is kept; rows without an id
    stay.  Planned as a merge join at every size."""
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select("doc_id")
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = resample.resample(docs, table(spark, sf_dir, "labels"), "doc_id", "text", GOOD)
    return _without_rejected(docs, found)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_boilerplate(docs, "source", "text")
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without_rejected(docs, minhash.near_duplicates(docs, "doc_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rates = mixing.mix_rates(docs, table(spark, sf_dir, "labels"), "doc_id", "text", DOMAIN, MIX, "good")
    rates = rates.where("doc_id is not null").groupBy("doc_id").agg(F.max("copies").alias("mix_copies"))
    copies = F.coalesce("mix_copies", F.lit(1))
    mixed = docs.join(rates.hint("merge"), "doc_id", "left").where(copies > 0)
    return mixed.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), copies)).alias("mix_time")).drop("mix_time")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_codec.codec_digests(docs, "doc_id", "text", BYTE_BPE)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
