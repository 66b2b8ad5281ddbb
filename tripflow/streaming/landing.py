"""Incremental landing of raw Parquet files into bronze.

A Structured Streaming file source remembers, in its checkpoint, which
files it has already processed; run with ``trigger(availableNow=True)``
it lands every new file once and stops.  Re-running after new files
arrive lands only those (the file-level form of "skip what is already
landed"), and the parquet sink commits each micro-batch atomically, so a
lost executor or a killed run never duplicates or half-writes a file's
rows.  Both the checkpoint and the target must be on shared storage.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.session import scratch_path
from tripflow.sources.io import SchemaError, committed, local_frame, read_merged
from tripflow.sources.snapshots import Manifest, file_system, names_in

LOG = "_spark_metadata"
ENTRY = "path string, action string, modificationTime long"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_read", T.LongType(), False),
    ]
)


def _batches(spark: SparkSession, target: str) -> dict[int, str]:
    """Files of the sink's log by batch; a compacted one holds all before it.
    (Spark keeps the last hundred or so.)"""
    names = [n for n in names_in(spark, f"{target}/{LOG}") if n.split(".")[0].isdigit()]
    return {int(n.split(".")[0]): n for n in names}


def _entries(spark: SparkSession, target: str, names: list[str]) -> DataFrame:
    """Entries of log files.  Spark's readers pass over a sink's log, so they
    read a copy of these files."""
    copy = scratch_path(spark, "sink-log")
    util = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for n in names:
        fs, log = file_system(spark, f"{target}/{LOG}/{n}")
        to_fs, to = file_system(spark, f"{copy}/{n}")
        util.copy(fs, log, to_fs, to, False, conf)
    lines = spark.read.text(copy).where("value LIKE '{%'")
    return lines.select(F.from_json("value", ENTRY).alias("e")).select("e.*").where("action = 'add'")


def _upto(batches: dict[int, str], last: int) -> list[str]:
    """The log files that hold all entries of batches up to ``last``."""
    whole = max((b for b, n in batches.items() if b <= last and n.endswith(".compact")), default=-1)
    return [n for b, n in sorted(batches.items()) if whole <= b <= last]


def added_files(spark: SparkSession, target: str, before: dict[int, str]) -> list[str]:
    """Files that the sink committed after the batches of ``before``.

    Only log files of later batches are read, unless one of them is a
    compaction: then what the log held before is taken off by a join.  The
    driver gets the added files only, never the history.
    """
    now, last = _batches(spark, target), max(before, default=-1)
    later = {b: n for b, n in now.items() if b > last}
    if not later:
        return []
    added = _entries(spark, target, [n for n in _upto(now, max(later)) if n in later.values()])
    if last >= 0 and any(n.endswith(".compact") for n in later.values()):
        held = _upto(before, last)
        if set(held) <= set(now.values()):
            added = added.join(_entries(spark, target, held).select("path"), "path", "left_anti")
        else:  # cleaned meanwhile (a run of over a hundred batches): by time
            fs, log = file_system(spark, f"{target}/{LOG}/{before[last]}")
            if not fs.exists(log):
                raise IOError(f"{target}: batch {last} left the sink's log during the run")
            added = added.where(F.col("modificationTime") > fs.getFileStatus(log).getModificationTime())
    return sorted(unquote(r["path"]) for r in added.select("path").collect())


def land_incrementally(
    spark: SparkSession,
    source_dir: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Land the files of ``source_dir`` not landed before; one-row report.

    ``schema`` defaults to the union of the present files' columns, or the
    target's once it has data (a stream's schema is fixed).  A file with a
    column beyond it raises before anything is landed: pass the wider
    schema, with a new checkpoint, to take it in.
    """
    present = read_merged(spark, source_dir).schema
    before = _batches(spark, target)
    manifest = Manifest.load(spark, target)
    if schema is None:
        stored = manifest.schema if manifest else spark.read.parquet(target).schema if committed(spark, target) else None
        schema = stored if stored is not None and stored.fields else present
    beyond = sorted(set(present.names) - set(schema.names))
    if beyond:
        raise SchemaError(f"{source_dir}: files have columns that the stream's schema lacks: {beyond}")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        reader.parquet(source_dir)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"landing failed: {query.exception()}")
    if manifest is None and committed(spark, target):
        Manifest(T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])).save(spark, target)
    added = added_files(spark, target, before)  # counted by their footers
    rows = spark.read.schema(schema).parquet(*added).count() if added else 0
    return local_frame(spark, [("landed" if rows else "up to date", rows)], REPORT_SCHEMA)
