"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tripflow
from tripflow.session import scratch_path

_SHIPPED = "tripflow-package.zip"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors (once per application),
    so that functions running in tasks can be imported there.

    Also takes Arrow batches down from Spark's default of 10,000 rows: rows
    here are whole texts, and a batch is held on both sides of the pipe.
    """
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    sc = spark.sparkContext
    if any(f.endswith(_SHIPPED) for f in sc.listFiles):
        return
    root = os.path.dirname(os.path.abspath(tripflow.__file__))
    if not os.path.isdir(root):  # already imported from an archive
        return
    target = os.path.join(tempfile.mkdtemp(prefix="tripflow-"), _SHIPPED)
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tripflow", os.path.relpath(path, root)))
    sc.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column; null counts as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def stage(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage: what follows survives lost executors without
    recomputing, and a plan that reads the table twice runs it once.

    group_bytes: size of the files' row groups, for tables of large rows.
    The reader decodes 4,096 rows of a group at once, whatever their size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lowest(df: DataFrame, n: int, order: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the lowest ``order`` (a 64-bit hash), then ``ties``.

    A sort with a limit alone makes every task send ``n`` rows to one place.
    Here hashes are first counted by their upper 14 bits, and rows beyond the
    slice that holds the n-th are left out: about ``n`` rows are sent in all.
    """
    by_slice = {r["slice"]: r["count"] for r in df.groupBy(F.shiftright(order, 50).alias("slice")).count().collect()}
    seen = 0
    for slice_, count in sorted(by_slice.items()):  # 16,384 at most
        seen += count
        if seen >= n:
            df = df.where(F.col(order) <= F.lit(((slice_ + 1) << 50) - 1))
            break
    return df.orderBy(order, *ties).limit(n)
