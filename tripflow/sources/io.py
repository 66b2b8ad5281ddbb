"""Parquet layer I/O: schema-checked reads, replacing writes, landing.

Writes go through Spark's output committer, so a failed or retried task
never leaves partial files visible.  A replacing write makes a new version
of the layer, which becomes current by one pointer when it is committed
(:mod:`tripflow.sources.snapshots`): a failed or interrupted write leaves
the old layer as it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tripflow.functions.expr import quoted, row_hash
from tripflow.sources.snapshots import (
    Manifest,
    current_version,
    file_system,
    layer_path,
    new_version,
    remove,
    sweep,
    switch,
)

# Type families a required column may have.
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMESTAMP = (T.TimestampNTZType,)


class SchemaError(ValueError):
    pass


def check_schema(df: DataFrame, required: Mapping[str, tuple[type, ...]] | T.StructType) -> DataFrame:
    """Fail early, with every problem listed, if columns are missing or mistyped."""
    if isinstance(required, T.StructType):
        required = {f.name: (type(f.dataType),) for f in required.fields}
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, allowed in required.items():
        if name not in fields:
            problems.append(f"missing column {name!r}")
        elif not isinstance(fields[name], tuple(allowed)):
            want = "/".join(t.__name__ for t in allowed)
            problems.append(f"column {name!r} is {fields[name].simpleString()}, expected {want}")
    if problems:
        raise SchemaError("; ".join(problems))
    return df


def read_layer(
    spark: SparkSession,
    path: str,
    required: Mapping[str, tuple[type, ...]] | T.StructType | None = None,
) -> DataFrame:
    """The layer's current version.  Its columns come from the manifest where
    there is one: no file is opened before the job runs."""
    folder = layer_path(spark, path)
    manifest = Manifest.load(spark, folder)
    df = spark.read.schema(manifest.schema).parquet(folder) if manifest else spark.read.parquet(folder)
    return check_schema(df, required) if required is not None else df


def committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a dataset whose write was committed: it has a
    current version, or the committer's marker, or a streaming sink's log."""
    if current_version(spark, path):
        return True
    fs, _ = file_system(spark, path)
    return any(fs.exists(file_system(spark, f"{path}/{m}")[1]) for m in ("_SUCCESS", "_spark_metadata"))


def _written_schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """The columns as a read gives them: partition columns last, all nullable."""
    fields = [f for f in df.schema.fields if f.name not in partition_by]
    fields += [df.schema[c] for c in partition_by]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    sort_within: Sequence[str] = (),
    only_partitions: bool = False,
) -> str:
    """Write ``df`` as Parquet, as the new version of the layer ``path``.

    All of ``path`` is replaced once the new data are written.
    ``files`` coalesces to that many output files (for small gold tables);
    large layers keep their partitioning.  With ``partition_by`` and
    ``only_partitions`` just the partitions present in ``df`` are replaced,
    in the current version (dynamic partition overwrite), so re-running one
    month leaves the others alone.
    """
    spark = df.sparkSession
    if files is not None:
        df = df.coalesce(files)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    manifest = Manifest(_written_schema(df, partition_by))
    if only_partitions:
        if not partition_by:
            raise ValueError("only_partitions needs partition_by")
        now = current_version(spark, path)
        if now:
            stored = Manifest.load(spark, f"{path}/{now}")
            if stored and stored.schema != manifest.schema:
                raise SchemaError(f"{path}: the layer's columns are {stored.schema.simpleString()}")
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{now}")
            return path
    version = new_version(spark, path)
    try:
        writer.parquet(f"{path}/{version}")
        manifest.save(spark, f"{path}/{version}")
    except BaseException:
        remove(spark, f"{path}/{version}")
        raise
    switch(spark, path, version)
    sweep(spark, path)
    return path


#: Parts of 64-bit row hashes, so narrow that sums of 2**41 rows fit in a bigint.
_HASH_PARTS = ((0, 22), (22, 22), (44, 20))


def _checksum_parts(df: DataFrame) -> list:
    """Aggregates of an order-free checksum: sums of parts of the rows' hashes."""
    h = row_hash(df.schema, df.columns)
    return [
        F.coalesce(F.sum(F.shiftrightunsigned(h, at).bitwiseAND((1 << width) - 1)), F.lit(0)).alias(f"h{at}")
        for at, width in _HASH_PARTS
    ]


def _checksum(values: Mapping[str, int]) -> str:
    return f"{sum(values[f'h{at}'] << at for at, _ in _HASH_PARTS) % (1 << 64):016x}"


def content_checksum(df: DataFrame) -> str:
    """An order-free checksum of a frame's rows: the sum of their hashes,
    columns by name."""
    df = df.select(*[quoted(c) for c in sorted(df.columns)])
    return _checksum(df.agg(*_checksum_parts(df)).first().asDict())


def verify_write(
    spark: SparkSession, expected: T.StructType, expected_rows: int, path: str, expected_checksum: str | None = None
) -> DataFrame:
    """Read ``path`` back; raise if its columns, their types, its row count
    or (where given) its rows' checksum differ from what was written."""
    back = spark.read.parquet(path)
    want = sorted((f.name, f.dataType.simpleString()) for f in expected.fields)
    have = sorted((f.name, f.dataType.simpleString()) for f in back.schema.fields)
    if expected_rows and want != have:
        raise IOError(f"{path}: wrote columns {want}, read back {have}")
    rows = back.count()  # Parquet footers: no data pages are read
    if rows != expected_rows:
        raise IOError(f"{path}: wrote {expected_rows} rows, read back {rows}")
    if expected_checksum is not None and rows:
        found = content_checksum(back)
        if found != expected_checksum:
            raise IOError(f"{path}: wrote rows of checksum {expected_checksum}, read back {found}")
    return back


def preview(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in the order of all columns, nulls first: the same
    ones however the data are laid out.  Each task keeps ``n`` rows."""
    return small_result(df.orderBy(*[quoted(c).asc_nulls_first() for c in df.columns]).limit(n), n)


def read_merged(spark: SparkSession, source: str) -> DataFrame:
    """All files of ``source`` under one schema: a column that only some
    files have is null in the others; clashing types raise.  The footers
    are read by a Spark job."""
    return spark.read.option("mergeSchema", "true").parquet(source)


LAND_SCHEMA = T.StructType(
    [
        T.StructField("target", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_read", T.LongType(), True),
        T.StructField("rows_written", T.LongType(), False),
        T.StructField("columns", T.IntegerType(), False),
        T.StructField("same_schema", T.BooleanType(), False),
        T.StructField("same_content", T.BooleanType(), True),
        T.StructField("sample", T.ArrayType(T.StringType()), False),
    ]
)


def land(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    if_exists: str = "skip",
    partition_by: Sequence[str] = (),
    files: int | None = None,
    verify: str = "rows",
    sample_rows: int = 0,
) -> DataFrame:
    """Land raw data into the bronze layer and verify it.

    Files that differ in their columns are landed under the union of them.
    ``if_exists="skip"`` leaves a committed target untouched (status
    ``skipped``) and replaces any other; ``"replace"`` always rewrites.
    The new version is verified before it becomes current: rows, columns
    and types, and with ``verify="content"`` a checksum of all rows, taken
    as they are written and again as they are read back (one more read of
    the data).  ``files`` spreads the rows
    evenly over that many files (a round-robin shuffle: only worth it when
    the source arrives as a few large unsplittable files).  The report has
    one row: target, status, rows read from the source, rows read back,
    columns, whether columns and types read back are those written, whether
    the content is (null unless checked), and ``sample``: ``sample_rows``
    landed rows as JSON (see :func:`preview`).
    """
    if if_exists not in ("skip", "replace"):
        raise ValueError("if_exists must be 'skip' or 'replace'")
    if verify not in ("rows", "content"):
        raise ValueError("verify must be 'rows' or 'content'")

    def sample(back: DataFrame) -> list[str]:
        return [r[0] for r in preview(back, sample_rows).select(F.to_json(F.struct("*"))).collect()] if sample_rows else []

    if if_exists == "skip" and committed(spark, target):
        back = read_layer(spark, target)
        row = (target, "skipped", None, back.count(), len(back.columns), True, None, sample(back))
        return local_frame(spark, [row], LAND_SCHEMA)
    src = read_merged(spark, source) if isinstance(source, str) else source
    if files:
        src = src.repartition(files)
    # Count the rows as they are written: the observed metric sits in the
    # write's final (result) stage, where Spark merges each partition's
    # update exactly once even when tasks are retried, so the source is
    # not read a second time just to be counted.
    seen = Observation("land")
    named = src.select(*[quoted(c) for c in sorted(src.columns)])
    metrics = [F.count(F.lit(1)).alias("rows"), *(_checksum_parts(named) if verify == "content" else [])]
    version = new_version(spark, target)
    beside = f"{target}/{version}"
    writer = src.observe(seen, *metrics).write
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(beside)
        got = seen.get
        checksum = _checksum(got) if verify == "content" else None
        back = verify_write(spark, src.schema, int(got["rows"]), beside, checksum)
        Manifest(_written_schema(src, partition_by), int(got["rows"]), checksum).save(spark, beside)
    except BaseException:
        remove(spark, beside)
        raise
    rows = back.count()
    content = True if verify == "content" else None
    report = (target, "landed", int(got["rows"]), rows, len(back.columns), True, content, sample(back))
    switch(spark, target, version)
    sweep(spark, target)
    return local_frame(spark, [report], LAND_SCHEMA)


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a frame.

    Made from an Arrow table, it is a local relation: reading it runs no
    Spark job.
    """
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema.fields)
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
    return spark.createDataFrame(table, schema)


def small_result(df: DataFrame, max_rows: int) -> DataFrame:
    """Run ``df`` once and keep its rows as a local frame, for results with
    a known small bound (a one-row aggregate, one row per parameter value).

    Reading the frame again never re-runs the plan and no executor holds
    it.  At most ``max_rows + 1`` rows are fetched; more raises, so an
    unexpected size can never flood the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows, got more")
    return local_frame(df.sparkSession, rows, df.schema)
