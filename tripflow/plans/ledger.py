"""A ledger of finished steps, so that a run goes on where one stopped.

A step is known by its name and the fingerprint of what it depends on: the
versions of the layers it reads (a new version has a new name) and its
settings.  Its entry is one small file, written when the step's output is
committed, and holds what later steps need of it.  A step that is recorded
with the same fingerprint is not run again; another fingerprint, or no
entry, runs it.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tripflow.sources.snapshots import file_system, read_text, write_text


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def _entry(self, step: str) -> str:
        return f"{self.path}/{step}.json"

    def done(self, step: str, inputs: str) -> dict | None:
        """What the step left, if it is recorded with these inputs."""
        text = read_text(self.spark, self._entry(step))
        entry = json.loads(text) if text else None
        return entry["left"] if entry and entry["inputs"] == inputs else None

    def record(self, step: str, inputs: str, left: dict | None = None) -> dict:
        fs, folder = file_system(self.spark, self.path)
        fs.mkdirs(folder)
        write_text(self.spark, self._entry(step), json.dumps({"inputs": inputs, "left": left or {}}))
        return left or {}
