"""Size-tiered compaction of document shards under a versioned manifest.

Arrivals are appended as small immutable Parquet shards.  Shards of similar
size form a tier; a tier with enough shards is merged into files of a target
size.  Every change is a new manifest version, written under a temporary name
and renamed to the next free number, which fails if another writer took it.  A
manifest lists the shards that came and went; a complete list follows when the
changes outweigh it, so that a small commit stays small in a store of any size.
Readers open exactly the shards of one version.

Shards hold rows as they came: nulls in any column, empty and very long texts,
repeated rows and further columns of any name stay as they are, and a table
without rows is a commit of empty shards.  Rows have no order.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..plans.manifests import Manifests


#: Manifests of changes in a row before a complete list.
DELTAS = 64


@dataclass(frozen=True)
class Shard:
    """A Parquet file of the store: name below the root, size and the commit that added it."""

    name: str
    bytes: int
    added: int


class ShardStore:
    """A set of shards below ``root``, any path that Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, root)

    def version(self) -> int:
        return self.manifests.newest()

    def _manifest(self, version: int) -> tuple[dict, list[Shard]]:
        """A manifest and all shards of its version."""
        last = self.manifests.read(version)
        shards: dict[str, Shard] = {}
        for held in [*self.manifests.read_all(list(range(last["complete"], version))), last]:
            for name in held["removed"]:
                del shards[name]
            shards.update((s["name"], Shard(**s)) for s in held["added"])
        if last["count"] != len(shards):
            raise ValueError(f"manifest {version} is damaged")
        return last, list(shards.values())

    def read_manifest(self, version: int | None = None) -> tuple[int, StructType | None, list[Shard]]:
        """Version, the rows' schema (None for an empty store), and the shards."""
        version = self.version() if version is None else version
        if not version:
            return 0, None, []
        held, shards = self._manifest(version)
        return version, StructType.fromJson(held["schema"]), shards

    def _commit(self, base: int, schema: StructType, shards: list[Shard], added: list[Shard], removed: list[Shard] = ()) -> int:
        """A version with ``shards``, those of ``base`` without ``removed`` and with ``added``: as changes, or complete when changes outweigh it."""
        before = self.manifests.read(base) if base else {"complete": 0, "changes": 0}
        complete, changes = before["complete"], before["changes"] + len(added) + len(removed)
        if not complete or changes > len(shards) or base - complete >= DELTAS:
            complete, changes, added, removed = base + 1, 0, shards, []
        state = {"count": len(shards), "complete": complete, "changes": changes, "schema": schema.jsonValue()}
        return self.manifests.commit(base, {**state, "added": [asdict(s) for s in added], "removed": [s.name for s in removed]})

    # shards

    def _written(self, df: DataFrame, added: int) -> list[Shard]:
        """Write ``df`` as one commit's shards and list the files; unlisted leftovers are never read."""
        folder = f"data/{added:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        files = self.manifests.fs.listStatus(self.manifests.path(folder))
        return [Shard(f"{folder}/{s.getPath().getName()}", s.getLen(), added) for s in files if s.getPath().getName().startswith("part-")]

    def append(self, df: DataFrame) -> int:
        """Add arrivals as they are partitioned, one small shard a partition; returns the new version."""
        base, schema, shards = self.read_manifest()
        kinds = lambda kind: [(f.name, f.dataType.simpleString()) for f in kind]
        if schema is not None and kinds(schema) != kinds(df.schema):
            raise ValueError("the arrivals have other columns than the store")
        new = self._written(df, base + 1)
        return self._commit(base, schema or df.schema, shards + new, new)

    def _rows(self, schema: StructType, shards: list[Shard]) -> DataFrame:
        if not shards:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.name}" for s in shards])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version."""
        _, schema, shards = self.read_manifest(version)
        if schema is None:
            raise ValueError("the store is empty")
        return self._rows(schema, shards)

    def plan(self, shards: list[Shard], target: int, fan_in: int, floor: int) -> list[list[Shard]]:
        """Groups of shards to merge: of each tier with ``fan_in`` shards or more, runs that fill target-sized files.

        A tier spans a factor of ``fan_in`` in size, all shards under ``floor``
        bytes being one.  Shards of at least half the target are finished.
        """
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes < target / 2:
                tiers.setdefault(int(math.log(max(s.bytes, floor) / floor, fan_in) + 1e-9), []).append(s)
        groups = []
        for _, members in sorted(tiers.items()):
            members.sort(key=lambda s: (s.added, s.name))
            run, size = [], 0
            for s in members:
                if run and size + s.bytes > target:
                    groups.append(run)
                    run, size = [], 0
                run.append(s)
                size += s.bytes
            if len(run) >= fan_in:
                groups.append(run)
        return [g for g in groups if len(g) > 1]

    def compact(self, target: int = 128 << 20, fan_in: int = 4, floor: int = 1 << 20, groups_a_pass: int | None = None) -> int:
        """Merge tiers until none is full; returns the newest version.

        Each pass is one job and one commit of at most ``groups_a_pass`` groups,
        as many as the cluster has cores (64 at least) if that is None.
        A group is read by one task and written as one file, so nothing is
        shuffled and a task holds no more than a target-sized file.
        """
        most = groups_a_pass or max(64, self.spark.sparkContext.defaultParallelism)
        while True:
            base, schema, shards = self.read_manifest()
            groups = self.plan(shards, target, fan_in, floor)[:most]
            if not groups:
                return base
            merged = [s for g in groups for s in g]
            gone = {s.name for s in merged}
            new = self._written(reduce(DataFrame.union, [self._rows(schema, g).coalesce(1) for g in groups]), base + 1)
            self._commit(base, schema, [s for s in shards if s.name not in gone] + new, new, merged)

    def expire(self, keep: int = 1) -> int:
        """Delete old manifests, and the shards that only they list; returns the number of files deleted.

        The newest ``keep`` versions stay whole, and so do those back to the
        complete list that they build on.
        """
        versions = self.manifests.versions()
        if not versions:
            return 0
        first = self.manifests.read(versions[-keep:][0])["complete"]
        old = self.manifests.read_all([v for v in versions if v < first])
        live = {s["name"] for held in self.manifests.read_all([v for v in versions if v >= first]) for s in held["added"]}
        gone = {s["name"] for held in old for s in held["added"]} - live
        for held in old:
            self.manifests.delete(held["version"])
        for name in gone:
            self.manifests.fs.delete(self.manifests.path(name), False)
        return len(gone)


SQL = "SELECT doc_id, source, lang, n_chars, sha256(coalesce(text, '')) AS text_sha256 FROM documents"
