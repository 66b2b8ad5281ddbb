"""One month end to end: land -> silver -> profile -> gold -> report.

The same jobs a user runs one after another (J1-J6), as plain function
calls in one session.  Silver is built before the profile so the profile
takes its duplicate figures from the copy counts the silver dedupe
staged: bronze goes through one full-row shuffle, not two.  Every layer
is written and read back, so no plan is run twice and a lost executor
never costs more than its own tasks of the current job.

Finished steps are recorded in a ledger.  A run that failed or was killed
goes on at the first unfinished step: landed bronze, silver and its staged
table, profile and gold are taken as they are while what they were made of
is the same version.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripflow.columns import TRIP, TripColumns
from tripflow.plans import specs
from tripflow.plans.gold import refresh_gold, write_gold
from tripflow.plans.ledger import Ledger, fingerprint
from tripflow.plans.profile_job import profile
from tripflow.plans.report_job import report
from tripflow.plans.silver import SilverBuild, build_silver, restore_silver
from tripflow.sources.io import committed, land, read_layer, write_layer
from tripflow.sources.layout import Layout
from tripflow.sources.snapshots import layer_path


@dataclass
class MonthRun:
    landed: DataFrame  # one-row landing report
    figures: dict[str, DataFrame]  # bronze profile
    built: SilverBuild  # silver, funnel, rejects, tuning
    gold: dict[str, DataFrame]  # read back from the gold layer
    reports: dict[str, DataFrame]
    steps_run: list[str]  # those that were not finished before


def run_month(
    spark: SparkSession,
    source: str | DataFrame,
    layout: Layout,
    c: TripColumns = TRIP,
    if_exists: str = "skip",
    year: int = specs.TARGET_YEAR,
    month: int = specs.TARGET_MONTH,
    keep_staged: bool = False,
    resume: bool = True,
) -> MonthRun:
    """Land ``source`` into ``layout`` (skipped when already landed unless
    ``if_exists="replace"``), build silver and gold of one month, and write
    the profile figures, the cleaning funnel and the reports (all small)
    under ``layout.reports``, from which they are read back.  The staged
    copy of bronze is removed at the end.  ``resume=False`` runs every step."""
    ledger, run = Ledger(spark, layout.ledger), []
    landed = land(spark, source, layout.bronze, if_exists=if_exists)
    if landed.first()["status"] == "landed":
        run.append("land")
    bronze = specs.check_trips(read_layer(spark, layout.bronze), c)
    base = fingerprint(layer_path(spark, layout.bronze), c, year, month, specs.IQR_MULTIPLIERS, specs.min_retain_ratio())

    def step(name: str, inputs: str, work: Callable[[], dict | None], usable: Callable[[dict], bool]) -> dict:
        left = ledger.done(name, inputs) if resume else None
        if left is None or not usable(left):
            left = ledger.record(name, inputs, work())
            run.append(name)
        return left

    builds: list[SilverBuild] = []

    def silver() -> dict:
        builds.append(build_silver(bronze, target=layout.silver, c=c, year=year, month=month))
        return {**builds[0].details(), "version": layer_path(spark, layout.silver)}

    def silver_usable(left: dict) -> bool:
        """Its version is current, and the staged table is there if a step
        that reads it is still to come."""
        if left["version"] != layer_path(spark, layout.silver):
            return False
        over = fingerprint(base, left["version"])
        finished = ledger.done("profile", over) is not None and ledger.done("reports", over) is not None
        return finished or committed(spark, left["staged_path"])

    details = step("silver", base, silver, silver_usable)
    built = builds[0] if builds else restore_silver(bronze, details, layout.silver, c, year, month)
    over = fingerprint(base, details["version"])

    def kept(frames: dict[str, DataFrame], prefix: str = "") -> dict:
        for name, frame in frames.items():
            write_layer(frame, f"{layout.reports}/{prefix}{name}", files=1)
        return {"names": sorted(frames)}

    def read(left: dict, prefix: str = "") -> dict[str, DataFrame]:
        return {name: read_layer(spark, f"{layout.reports}/{prefix}{name}") for name in left["names"]}

    def figures() -> dict:
        return kept(profile(bronze, c, duplicates=built.duplicate_stats(), year=year, month=month), "profile_")

    def gold_tables() -> dict[str, DataFrame]:
        return {name: read_layer(spark, layout.gold(name)) for name in specs.gold_specs(c)}

    def gold() -> dict:
        write_gold(refresh_gold(built.silver, layout, c, whole=True), layout)
        return {}

    def reports() -> dict:
        made = report(bronze, built.silver, gold_tables(), c)
        return kept({**made, "funnel": built.funnel(), "candidates": built.candidates})

    there = lambda left: True
    profiled = step("profile", over, figures, there)
    step("gold", over, gold, lambda left: all(committed(spark, layout.gold(n)) for n in specs.gold_specs(c)))
    reported = step("reports", over, reports, there)
    if not keep_staged:
        built.discard()
    return MonthRun(landed, read(profiled, "profile_"), built, gold_tables(), read(reported), run)
