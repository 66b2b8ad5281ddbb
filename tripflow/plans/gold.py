"""Silver -> gold: the eight summary tables, by way of two roll-ups.

Silver is read once per roll-up: by (date, hour, weekday, vendor, payment)
and by (date, pickup, dropoff).  Both are small (thousands of rows, and
routes times days), written once, and the eight tables are derived from them.

``refresh_gold`` keeps the roll-ups: a new day's trips (or a day that came
again) replace that day's states only, and the tables follow from the
states of all days.  At 100 TB that reads one day instead of the archive.

``build_gold(one_pass=False)`` runs one aggregate per table instead (eight
column-pruned scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.columns import TRIP, TripColumns
from tripflow.operators.rollup import RollUp, derive_all, partials
from tripflow.operators.sketches import quantile_sketches
from tripflow.operators.summarise import summarise
from tripflow.plans import specs
from tripflow.session import scratch_path
from tripflow.sources.io import read_layer, write_layer
from tripflow.sources.layout import Layout


def gold_rollups(c: TripColumns = TRIP) -> tuple[RollUp, ...]:
    """The grains that the gold tables are derived from, day by day."""
    tables = specs.gold_specs(c)
    by_place = [s for s in tables.values() if set(s.keys) & {c.pickup_loc, c.dropoff_loc}]
    by_time = [s for s in tables.values() if s not in by_place]
    return (
        RollUp.serving("by_time_vendor_payment", (c.date, c.hour, c.dayofweek, c.vendor, c.payment), by_time),
        RollUp.serving("by_route", (c.date, c.pickup_loc, c.dropoff_loc), by_place),
    )


def build_gold(silver: DataFrame, c: TripColumns = TRIP, one_pass: bool = True) -> dict[str, DataFrame]:
    """The gold tables of ``silver``, derived from staged roll-ups."""
    table_specs = specs.gold_specs(c)
    if not one_pass:
        return {name: summarise(silver, spec) for name, spec in table_specs.items()}
    spark, rollups, states = silver.sparkSession, gold_rollups(c), {}
    for r in rollups:
        state = partials(silver, r)
        path = scratch_path(spark, f"gold-{r.name}")
        state.write.parquet(path)
        states[r.name] = spark.read.schema(state.schema).parquet(path)
    return derive_all(states, rollups, list(table_specs.values()))


def refresh_gold(silver: DataFrame, layout: Layout, c: TripColumns = TRIP, whole: bool = False) -> dict[str, DataFrame]:
    """Gold tables of all days stored so far, after the states of the days
    in ``silver`` (all trips of those days) have replaced the stored ones;
    with ``whole``, ``silver`` is all there is and other days go."""
    spark, rollups = silver.sparkSession, gold_rollups(c)
    for r in rollups:
        # few rows a day: one file each
        state = partials(silver, r).repartition(c.date)
        write_layer(state, layout.rollup(r.name), partition_by=[c.date], only_partitions=not whole)
    return stored_gold(spark, layout, c)


def refresh_sketches(silver: DataFrame, layout: Layout, c: TripColumns = TRIP) -> DataFrame:
    """Quantile sketches of all days stored so far, after those of the days in
    ``silver`` (all trips of those days) have replaced the stored ones."""
    own = quantile_sketches(silver, (c.date,), specs.range_columns(c)).repartition(c.date)
    write_layer(own, layout.sketches, partition_by=[c.date], only_partitions=True)
    return read_layer(silver.sparkSession, layout.sketches)


def stored_gold(spark: SparkSession, layout: Layout, c: TripColumns = TRIP) -> dict[str, DataFrame]:
    """The gold tables derived from the stored roll-ups."""
    rollups = gold_rollups(c)
    states = {r.name: read_layer(spark, layout.rollup(r.name)) for r in rollups}
    return derive_all(states, rollups, list(specs.gold_specs(c).values()))


def write_gold(tables: dict[str, DataFrame], layout: Layout) -> dict[str, str]:
    """Each gold table as one sorted file; returns the paths."""
    out = {}
    for name, df in tables.items():
        out[name] = write_layer(df, layout.gold(name), files=1)
    return out
