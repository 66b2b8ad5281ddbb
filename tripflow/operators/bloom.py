"""A Bloom filter as a table, for keys too many for one machine.

Keys are 64-bit.  Each belongs to one block of 32,768 bits and sets PROBES
bits there (a blocked filter): building it shuffles a key once, and testing
a key reads one row of the table.  The table has a row per block, spread
like any other; nothing is broadcast or collected.

A key that was added is always found.  With BITS_PER_KEY bits a key, one
that wasn't is found with a chance of about 1 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
BITS_PER_KEY = 12
PROBES = 5


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(blocks))


def _bit(key: Column, probe: Column) -> Column:
    return F.pmod(F.xxhash64(key, probe), F.lit(BLOCK_BITS))


def bloom_table(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of a one-column frame of keys: block, bitmap, blocks."""
    key = F.col("key")
    rows = keys.toDF("key").select(key, _block(key, blocks).alias("block")).repartition("block")
    probes = rows.select("block", "key", F.explode(F.sequence(F.lit(0), F.lit(PROBES - 1))).alias("probe"))
    bits = probes.select("block", _bit(key, F.col("probe")).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")).withColumn("blocks", F.lit(blocks))


def might_hold(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Those of ``keys`` (key) that the filter finds: all that were added,
    and few others."""
    asked = keys.withColumn("block", _block(F.col("key"), blocks))
    # a bitmap's bytes hold bits from the lowest up
    bit = _bit(F.col("key"), F.col("probe"))
    byte = F.conv(F.hex(F.expr("substring(bitmap, CAST(bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    probed = (
        asked.join(bloom.select("block", "bitmap"), "block")
        .withColumn("probe", F.explode(F.sequence(F.lit(0), F.lit(PROBES - 1))))
        .withColumn("bit", bit)
        .withColumn("set", F.expr("1 << CAST(bit % 8 AS INT)").bitwiseAND(byte) != 0)
    )
    return probed.where("set").groupBy("key").agg(F.count_distinct("probe").alias("n")).where(F.col("n") == PROBES).select("key")
