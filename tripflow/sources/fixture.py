"""Derive a ``trips`` table from the TPC-H style ``lineitem`` table.

The test tables hold no trip records, so trips are mapped from line items
with closed-form arithmetic (no randomness).  The mapping plants every
defect the cleaning rules look for: exact duplicate rows, nulls, an
invalid vendor code, negative / tiny fares, zero and huge distances,
negative, too short and too long durations, and pickups outside the
target month on both sides.  It is a pure projection plus one
``UNION ALL``, so it scales with ``lineitem`` and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.columns import TRIP, TripColumns
from tripflow.functions.expr import ts_literal

# Fixed values of the mapping (shared with the SQL oracle).
BASE_TS = "2025-12-30 00:00:00"  # first possible pickup
OFFSET_SPAN_S = 3024000  # 35 days of pickup offsets
DUPLICATE_EVERY = 100  # orders with l_orderkey % 100 = 0 appear twice
LONG_TRIP_EVERY, LONG_TRIP_REST = 50, 7  # suppliers with l_suppkey % 50 = 7 (valid vendors) drive 30000 s
LONG_TRIP_S = 30000
PLANT_EVERY = 199  # l_partkey % 199 = k plants one defect in an otherwise valid row:
PLANTED = {  # k: (field, value); each cleaning rule decides some rows by itself
    1: ("pickup", None), 2: ("dropoff", None), 3: ("distance", None), 4: ("fare", None), 5: ("total", None),
    6: ("pickup_loc", None), 7: ("dropoff_loc", None), 8: ("vendor", None), 9: ("fare", 600.0),
    10: ("total", -1.0), 11: ("total", 1500.0), 12: ("tip", -0.5), 13: ("passengers", 0),
}

LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
)


def _offset_s() -> Column:
    return (
        F.col("l_orderkey") * 7919 + F.col("l_partkey") * 613 + F.col("l_linenumber") * 3571
    ) % OFFSET_SPAN_S


def _duration_s() -> Column:
    return F.when(F.col("l_suppkey") % LONG_TRIP_EVERY == LONG_TRIP_REST, F.lit(LONG_TRIP_S)).otherwise(
        (F.col("l_partkey") * 37 + F.col("l_orderkey") * 11) % 4000 - 100
    )


def trips_from_lineitem(lineitem: DataFrame, c: TripColumns = TRIP) -> DataFrame:
    li = lineitem.select(*LINEITEM_COLUMNS)
    rows = li.unionAll(li.filter(F.col("l_orderkey") % DUPLICATE_EVERY == 0))
    base = ts_literal(BASE_TS)
    off = _offset_s()
    price = F.col("l_extendedprice")
    mapped = rows.select(
        F.col("l_partkey"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(6))
        .otherwise(1 + F.col("l_suppkey") % 2)
        .cast("int")
        .alias(c.vendor),
        F.timestamp_add("SECOND", off, base).alias(c.pickup),
        F.timestamp_add("SECOND", off + _duration_s(), base).alias(c.dropoff),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "O"), F.lit(None))
        .otherwise(F.col("l_linenumber"))
        .cast("bigint")
        .alias(c.passengers),
        F.when((F.col("l_tax") == 0) & (F.col("l_linenumber") == 1), F.lit(0.0))
        .when(F.col("l_partkey") % 97 == 0, F.col("l_quantity") * 5)
        .otherwise(F.col("l_quantity") / 4)
        .cast("double")
        .alias(c.distance),
        F.when((F.col("l_linenumber") == 2) & (F.col("l_discount") == 0.1), -price / 1000)
        .otherwise(price / 1000)
        .alias(c.fare),
        (F.col("l_discount") * price / 500).alias(c.tip),
        (price / 1000 + F.col("l_discount") * price / 500 + F.col("l_tax") * 100).alias(c.total),
        F.when(F.col("l_orderkey") % 6 == 5, F.lit(None))
        .otherwise(F.col("l_orderkey") % 6)
        .cast("bigint")
        .alias(c.payment),
        (1 + F.col("l_partkey") % 40).cast("int").alias(c.pickup_loc),
        (1 + F.col("l_suppkey") % 25).cast("int").alias(c.dropoff_loc),
    )
    return _with_planted(mapped, c).drop("l_partkey")


def _with_planted(df: DataFrame, c: TripColumns) -> DataFrame:
    rest = F.col("l_partkey") % PLANT_EVERY
    out = {}
    for k, (name, value) in PLANTED.items():
        column = getattr(c, name)
        kept = out.get(column, F.col(column))
        out[column] = F.when(rest == k, F.lit(value).cast(df.schema[column].dataType)).otherwise(kept)
    return df.withColumns(out)


def load_trips(spark: SparkSession, sf_dir: str, c: TripColumns = TRIP) -> DataFrame:
    return trips_from_lineitem(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"), c)
