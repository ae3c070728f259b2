"""State tables: versions of Parquet data, of which the newest manifest names one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .manifests import Manifests


class StateTable:
    """A table whose whole state is replaced at once; a reader sees one version."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str):
        self.spark, self.root = spark, root.rstrip("/")
        self.empty = spark.createDataFrame([], schema)
        self.manifests = Manifests(spark, root)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.manifests.newest() if version is None else version
        if not version:
            return self.empty
        return self.spark.read.schema(self.empty.schema).parquet(f"{self.root}/{self.manifests.read(version)['folder']}")

    def update(self, change: Callable[[DataFrame], DataFrame], once: tuple[str, int] | None = None, identity: str | None = None) -> int:
        """Write ``change`` of the newest state as the next version.

        With ``once``, a writer's name and the number of its update, one that
        is sent again changes nothing.  No number after a writer's first may be
        left out, as what it held would be lost; that of a writer with an
        identity is 0.  A writer that has an ``identity``
        keeps its name: another one under that name is refused, as its numbers
        are not the same updates.  A manifest holds one entry a writer.
        """
        base = self.manifests.newest()
        done = self.manifests.read(base)["done"] if base else {}
        if once is not None:
            name, number = once
            known, last = done.get(name, [identity, -1])
            if known != identity:
                raise ValueError(f"{name} writes to {self.root} from another checkpoint; a second stream needs a name of its own")
            if number <= last:
                return base
            if number > last + 1 and (name in done or identity is not None):
                raise ValueError(f"{name} sends update {number} to {self.root} after {last}")
            done = {**done, name: [identity, number]}
        folder = f"data/{base + 1:012d}-{uuid.uuid4().hex}"
        change(self.read(base)).write.parquet(f"{self.root}/{folder}")
        return self.manifests.commit(base, {"folder": folder, "done": done})


class Registry:
    """Resource tables: artifacts by path, registered with a version guard, and rebuilt from stored files."""

    SCHEMA = "resource_id string, version string, job_id string, path string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.state = spark, StateTable(spark, f"{root}/registry", self.SCHEMA)

    def register(self, artifacts: DataFrame) -> None:
        from ..operators.catalogue import register_table

        self.state.update(lambda old: register_table(old, artifacts))

    def table(self, resource: str) -> DataFrame:
        row = self.state.read().filter(f"resource_id = '{resource}'").first()
        if row is None:
            raise KeyError(resource)
        return self.spark.read.parquet(row["path"])

    def rebuild(self, objects: DataFrame) -> DataFrame:
        """Register the live artifact of every folder anew (object_key, size); returns the failures (path, error)."""
        from pyspark.sql import functions as F

        from ..operators.catalogue import classify_artifacts

        live = classify_artifacts(objects).filter("kind = 'live'")
        name = F.element_at(F.split("object_key", "/"), -1)
        rows = live.select(F.element_at(F.split("folder", "/"), -1).alias("resource_id"), F.regexp_extract(name, r"_(.*)\.parquet$", 1).alias("version"), F.lit("rebuild").alias("job_id"), F.col("object_key").alias("path"), "size")
        good = rows.filter("size > 0")
        self.state.update(lambda _: good.drop("size"))
        return rows.filter("size <= 0").select("path", F.lit("empty file").alias("error"))
