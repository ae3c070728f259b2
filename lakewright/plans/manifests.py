"""Numbered manifests: complete descriptions of a store's state, committed atomically."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from .folders import publish_file


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version first."""


class Manifests:
    """JSON manifests below ``root``/manifests.

    A manifest is written under a temporary name and then given the next free
    number, which fails if that is taken; ``publish_file`` says on which file
    systems.  Readers see a whole manifest or none.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._paths(f"{self.root}/{name}" if name else self.root)

    def _name(self, version: int) -> str:
        return f"manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        """All versions that are there, in order."""
        if not self.fs.exists(self.path("manifests")):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path("manifests"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def newest(self) -> int:
        """The newest version; 0 for an empty store."""
        return max(self.versions(), default=0)

    def exists(self, version: int) -> bool:
        return self.fs.exists(self.path(self._name(version)))

    def read_all(self, versions: list[int]) -> list[dict]:
        """Several manifests in one job, in the order of their versions."""
        if not versions:
            return []
        rows = self.spark.read.text([self.path(self._name(v)).toString() for v in versions], wholetext=True).collect()
        held = sorted((json.loads(r["value"]) for r in rows), key=lambda m: m["version"])
        if [m["version"] for m in held] != sorted(versions):
            raise ValueError(f"manifests {min(versions)} to {max(versions)} are damaged")
        return held

    def read(self, version: int) -> dict:
        return self.read_all([version])[0]

    def commit(self, base: int, state: dict) -> int:
        version = base + 1
        temporary = self.path(f"manifests/.{version:012d}-{uuid.uuid4().hex}")
        out = self.fs.create(temporary, False)
        out.write(bytearray(json.dumps({"version": version, **state}).encode()))
        out.close()
        if not publish_file(self.spark, temporary.toString(), self.path(self._name(version)).toString()):
            raise ConcurrentCommit(f"version {version} exists already")
        return version

    def delete(self, version: int) -> None:
        self.fs.delete(self.path(self._name(version)), False)
