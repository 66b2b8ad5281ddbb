"""Versioned layers: a snapshot pointer instead of a rename.

A layer is a folder that holds versions (``v-<number>-<id>``, each a whole
Parquet dataset with a manifest) and ``_current``, whose entries name them.
The entry of the highest number is the layer's version:

    bronze/_current/000000000007-v-7-1c2d     (empty)
    bronze/v-7-1c2d/...parquet, _SUCCESS, _manifest.json

A writer fills a new version, unseen by readers, and switches to it by
creating one entry, which a file system does at once or not at all; no
data move.  Interrupted before that, the old version stays current;
interrupted after it, the new one is.  Versions that are no longer named,
also those of killed writers, go with the next switch.  A layer has one
writer at a time; a reader resolves the pointer once.

The manifest holds the columns, rows and content checksum that were
written, so a reader plans without opening a file's footer, and a check
knows what to expect.

A folder without ``_current`` (given files, a streaming sink) is its own,
only version.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

POINTERS, MANIFEST = "_current", "_manifest.json"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path in it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def remove(spark: SparkSession, path: str) -> None:
    fs, hpath = file_system(spark, path)
    fs.delete(hpath, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder; none if there is no such folder."""
    fs, hpath = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, hpath = file_system(spark, path)
    if not fs.exists(hpath):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place at once: written beside, then renamed."""
    fs, hpath = file_system(spark, path)
    _, beside = file_system(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex[:8]}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(hpath):
        fs.delete(hpath, False)
    if not fs.rename(beside, hpath):
        raise IOError(f"{path}: cannot be written")


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of a layer's version; None without a pointer."""
    entries = [n for n in names_in(spark, f"{path}/{POINTERS}") if "-v-" in n]
    return entries[-1].split("-", 1)[1] if entries else None


def layer_path(spark: SparkSession, path: str) -> str:
    """The folder that holds a layer's files now."""
    version = current_version(spark, path)
    return f"{path}/{version}" if version else path


def new_version(spark: SparkSession, path: str) -> str:
    """A name for the next version."""
    now = current_version(spark, path)
    return f"v-{int(now.split('-')[1]) + 1 if now else 1}-{uuid.uuid4().hex[:8]}"


def switch(spark: SparkSession, path: str, version: str) -> None:
    """``version`` becomes current: one entry is created."""
    fs, folder = file_system(spark, f"{path}/{POINTERS}")
    fs.mkdirs(folder)
    entry = f"{path}/{POINTERS}/{int(version.split('-')[1]):012d}-{version}"
    if not fs.createNewFile(file_system(spark, entry)[1]):
        raise IOError(f"{path}: {version} is current already")


def sweep(spark: SparkSession, path: str) -> None:
    """Remove all of a layer but its current version."""
    version = current_version(spark, path)
    if version is None:
        return
    for name in names_in(spark, f"{path}/{POINTERS}")[:-1]:
        remove(spark, f"{path}/{POINTERS}/{name}")
    for name in names_in(spark, path):
        if name not in (POINTERS, version):
            remove(spark, f"{path}/{name}")


@dataclass(frozen=True)
class Manifest:
    """What was written: columns, and rows and checksum where counted."""

    schema: T.StructType
    rows: int | None = None
    checksum: str | None = None

    def save(self, spark: SparkSession, folder: str) -> None:
        text = json.dumps({"schema": json.loads(self.schema.json()), "rows": self.rows, "checksum": self.checksum})
        write_text(spark, f"{folder}/{MANIFEST}", text)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Manifest | None:
        text = read_text(spark, f"{folder}/{MANIFEST}")
        if text is None:
            return None
        found = json.loads(text)
        return cls(T.StructType.fromJson(found["schema"]), found["rows"], found["checksum"])
