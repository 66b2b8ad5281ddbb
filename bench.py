"""Bench: the whole pipeline on the trips fixture at one scale factor.

Prints ONE JSON line:
  {"metric": "pipeline_seconds", "value": total, "unit": "sec",
   "queries": {...per phase...}, "stepwise": {...}, "sf": ...}

Phases (library form): land bronze, silver (dedupe + rules + tuned IQR
+ features, written), profile (duplicate figures from silver's staged
copy counts), gold (two roll-ups, 8 tables derived and written), report,
plus single operators.  ``stepwise`` runs the same
semantics as plain one-action-per-figure Spark code (one count per
cleaning step, one quantile job per multiplier and column, one scan per
gold table) on the same session, for comparison.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_STEPWISE=0 to skip the comparison.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripflow.columns import TRIP as C  # noqa: E402
from tripflow.functions.features import add_features  # noqa: E402
from tripflow.operators import profile as P  # noqa: E402
from tripflow.operators.outliers import choose_multiplier, iqr_candidates, iqr_filter  # noqa: E402
from tripflow.operators.rules import clean  # noqa: E402
from tripflow.plans import specs  # noqa: E402
from tripflow.plans.gold import build_gold, write_gold  # noqa: E402
from tripflow.plans.profile_job import profile  # noqa: E402
from tripflow.plans.report_job import report  # noqa: E402
from tripflow.plans.silver import build_silver  # noqa: E402
from tripflow.session import get_session, scratch_root  # noqa: E402
from tripflow.sources.fixture import load_trips  # noqa: E402
from tripflow.sources.io import land, read_layer, write_layer  # noqa: E402
from tripflow.sources.layout import Layout  # noqa: E402


def timed(results: dict, name: str, fn):
    t0 = time.perf_counter()
    out = fn()
    results[name] = round(time.perf_counter() - t0, 3)
    return out


def collect_all(frames: dict) -> int:
    return sum(len(df.collect()) for df in frames.values())


#: Tables that a stepwise run shows again after writing them.
SHOWN = ("by_hour", "by_dayofweek", "by_date", "by_vendor", "by_payment", "by_pickup_location_top20")


def stepwise(spark, bronze_path: str, work: str) -> dict:
    """The comparator: the library's own operators, one action per figure
    (a count after each step, a filter run per multiplier, a job per table
    and per profile figure) instead of shared passes."""
    out: dict[str, float] = {}
    df = read_layer(spark, bronze_path)

    def profile_figures():
        lo, hi, bins = specs.FARE_HISTOGRAM
        figures = {
            "shape": P.shape(df),
            "describe": P.describe_numeric(df, specs.describe_columns(), 6),
            "nulls": P.null_counts(df),
            "duplicates": P.duplicate_stats(df),
            "by_date": P.count_by(df, F.to_date(C.pickup), C.date),
            "by_hour": P.count_by(df, F.hour(C.pickup), C.hour),
            "vendor": P.distribution(df, C.vendor),
            "payment": P.distribution(df, C.payment),
            "ranges": P.value_ranges(df, specs.range_columns(), 6),
            "quantiles": P.quantiles(df, specs.quantile_columns(), specs.QUANTILE_PROBS, method="approx"),
            "issues": P.issues(df, specs.profile_checks()),
            "histogram": P.histogram(df, C.fare, lo, hi, bins),
        }
        return collect_all(figures)

    def silver():
        rows = df
        rows.count()
        for kept in range(len(specs.cleaning_steps(df)) + 1):
            rows = clean(df, specs.cleaning_steps(df)[:kept])
            rows.count()
        base = rows.count()
        tried = [(i, m, iqr_filter(rows, specs.iqr_columns(), m, method="approx").count())
                 for i, m in enumerate(specs.IQR_MULTIPLIERS)]
        table = spark.createDataFrame(
            [(i, float(m), n / base if base else 0.0) for i, m, n in tried],
            "position int, multiplier double, retain_ratio double",
        )
        chosen = choose_multiplier(table, specs.min_retain_ratio())
        done = add_features(iqr_filter(rows, specs.iqr_columns(), chosen, method="approx"))
        done.count()
        write_layer(done, f"{work}/stepwise_silver")

    def gold():
        rows = read_layer(spark, f"{work}/stepwise_silver")
        for name, table in build_gold(rows, one_pass=False).items():
            write_layer(table, f"{work}/stepwise_gold/{name}")
            if name in SHOWN:
                table.collect()

    timed(out, "profile", profile_figures)
    timed(out, "silver", silver)
    timed(out, "gold", gold)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]",
        app_name="tripflow-bench",
        shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")},
    )
    work = tempfile.mkdtemp(prefix="tripflow-bench-")
    scratch_root(spark)  # spark.checkpoint.dir, or a private folder when unset
    layout = Layout(work)
    q: dict[str, float] = {}

    # warm the JVM outside the timed phases (class loading, JIT of the
    # scan / aggregate / shuffle / Parquet write paths) on the tiny nation
    # table, so the first timed phase is not charged for it; the stepwise
    # comparison below runs on an equally warm JVM
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(1).collect()
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    warm = nation.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.max("n_name").alias("m"))
    warm.collect()
    warm.write.mode("overwrite").parquet(f"{work}/warmup")

    # the input: the trips, as often as BENCH_COPIES, each time in another
    # order number range, written once outside the timing
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    raw = f"{work}/raw"
    trips = load_trips(spark, sf_dir)
    parts = [trips.withColumn("l_orderkey", F.col("l_orderkey") + F.lit(i * 10**10)) for i in range(copies)]
    functools.reduce(lambda a, b: a.unionAll(b), parts).write.parquet(raw)

    timed(q, "land", lambda: land(spark, raw, layout.bronze, if_exists="replace").collect())
    bronze = read_layer(spark, layout.bronze)
    # silver first: the profile takes its duplicate figures from the copy
    # counts the silver dedupe staged, so bronze is shuffled once
    built = timed(q, "silver", lambda: build_silver(bronze, target=layout.silver))
    timed(q, "profile", lambda: collect_all(profile(bronze, duplicates=built.duplicate_stats())))
    timed(q, "funnel", lambda: built.funnel().collect())
    gold = timed(q, "gold", lambda: build_gold(built.silver))
    timed(q, "gold_write", lambda: write_gold(gold, layout))
    gold_read = {name: read_layer(spark, layout.gold(name)) for name in gold}
    timed(q, "report", lambda: collect_all(report(bronze, built.silver, gold_read)))
    total = round(sum(q.values()), 3)

    staged = spark.read.parquet(built.staged_path).filter("_reject_step = 0").drop("_reject_step", "_copies")
    timed(q, "iqr_candidates_8m", lambda: iqr_candidates(
        staged, specs.iqr_columns(), (0.05, 0.1, 0.25, 0.5, 1.5, 2.0, 2.5, 3.0)).table.collect())
    timed(q, "gold_per_table", lambda: collect_all(build_gold(built.silver, one_pass=False)))

    out = {
        "metric": "pipeline_seconds",
        "value": total,
        "unit": "sec",
        "queries": q,
        "sf": (re.search(r"sf([0-9.]+)", sf_dir) or [None, sf_dir])[1],
        "rows": {"bronze": bronze.count(), "silver": built.silver.count()},
    }
    if os.environ.get("BENCH_STEPWISE", "1") != "0":
        out["stepwise"] = stepwise(spark, layout.bronze, work)
        lib = q["silver"] + q["funnel"]
        out["stepwise"]["speedup_silver"] = round(out["stepwise"]["silver"] / lib, 2) if lib else None
        out["stepwise"]["speedup_profile"] = round(out["stepwise"]["profile"] / q["profile"], 2)
        gl = q["gold"] + q["gold_write"]
        out["stepwise"]["speedup_gold"] = round(out["stepwise"]["gold"] / gl, 2) if gl else None
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
