"""Which reader gets a resource, what happens when it fails, and when a cached copy will do."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import older_than
from ..plans.folders import shared_folder, stored

#: Readers in their fixed order, with the format texts that they take.
ORDER = {
    "datastore": (),
    "csv": ("csv",),
    "datapackage": ("json",),
    "json": ("json", "geojson"),
    "protobuf": ("gtfs-rt", "protobuf", "pb"),
    "log": ("log", "txt"),
    "file_reference": ("html", "docx", "map", "pdf", "tab", "tif"),
    "crawler": ("html", "zip"),
}


@dataclass(frozen=True)
class Reader:
    """A reader: its name, which resources it can read, and what it makes of them: (id, rows, error)."""

    name: str
    can_read: Column
    read: Callable[[DataFrame], DataFrame]


def can_read(reader: str) -> Column:
    """Whether a resource (format, url, datastore_active, file_name) is one for a reader; formats match by substring."""
    if reader == "datastore":
        return F.coalesce("datastore_active", F.lit(False)) & ~F.lower("url").endswith(".gz")
    found = reduce(lambda a, b: a | b, [F.contains(F.lower("format"), F.lit(x)) for x in ORDER[reader]])
    if reader == "datapackage":
        found = found & (F.lower("file_name") == "datapackage.json")
    return F.coalesce(found, F.lit(False))


def eligible_readers() -> Column:
    """Names of the readers for a resource, in order."""
    return F.filter(F.array(*[F.when(can_read(r), r) for r in ORDER]), lambda x: x.isNotNull())


def ingest_resources(resources: DataFrame, readers: Sequence[Reader]) -> DataFrame:
    """(id, status, reader, rows, errors) after each resource has gone to its readers in turn.

    The first reader that gives rows wins.  Errors are joined in the order of
    attempts; no rows is an error.  A 404 stops and marks the resource deleted;
    a resource that no reader takes is unsupported.  Every reader's outcome, and
    what is still open after it, is written before the next, so no reader runs
    twice and the plans don't grow with the number of readers.
    """
    folder = shared_folder(resources.sparkSession, "readers")
    empty = F.array().cast("array<string>")
    open_ = resources.withColumn("tried", empty).withColumn("known", F.lit(False))
    closed = []
    for reader in readers:
        mine = open_.filter(reader.can_read)
        seen = reader.read(mine.drop("tried", "known")).select("id", "rows", F.coalesce("error", F.when(F.col("rows") == 0, "no rows")).alias("error"))
        out = mine.join(stored(seen, f"{folder}/{len(closed)}-seen"), "id").withColumn("known", F.lit(True))
        tried = F.when(F.col("error").isNotNull(), F.concat("tried", F.array(F.concat(F.lit(f"{reader.name}: "), "error")))).otherwise(F.col("tried"))
        out = out.withColumn("tried", tried)
        gone = F.coalesce(F.contains("error", F.lit("404")), F.lit(False))
        closed.append(out.filter("error IS NULL").select("id", F.lit("completed").alias("status"), F.lit(reader.name).alias("reader"), "rows", F.array_join("tried", "; ").alias("errors")))
        closed.append(out.filter(gone).select("id", F.lit("deleted").alias("status"), F.lit(None).cast("string").alias("reader"), F.lit(0).alias("rows"), F.array_join("tried", "; ").alias("errors")))
        open_ = stored(open_.filter(~reader.can_read).unionByName(out.filter(F.col("error").isNotNull() & ~gone).select(open_.columns)), f"{folder}/{len(closed)}-open")
    closed.append(open_.select("id", F.when(F.col("known"), "failed").otherwise("unsupported").alias("status"), F.lit(None).cast("string").alias("reader"), F.lit(0).alias("rows"), F.array_join("tried", "; ").alias("errors")))
    return reduce(DataFrame.unionByName, closed)


def cache_decision(sources: DataFrame, cache: DataFrame, key: str, now: Column, hours: float = 168) -> DataFrame:
    """Sources with a decision: fetch without a copy, fresh within ``hours``, reuse if the origin is not newer or doesn't say, else fetch.

    A copy is used if the origin did not answer (``answered``).  An archive
    (``archive``) is always asked for: its copy is reused if the ``etag`` and
    ``last_modified`` that the origin tells are the copy's ``origin_etag`` and
    ``origin_modified``; if it tells neither, a copy within ``hours`` is.  Of
    these columns those that are not there are null; null is answered, and no
    archive.
    """
    joined = sources.join(cache, key, "left")
    known = lambda name: F.col(name) if name in joined.columns else F.lit(None)
    fresh = ~older_than(F.col("uploaded_at"), now, hours) & (F.col("uploaded_at").cast("timestamp") != F.timestamp_micros(F.unix_micros(now.cast("timestamp")) - int(hours * 3_600_000_000)))
    told = F.col("last_modified").isNotNull() | known("etag").isNotNull()
    agrees = lambda now_, then: now_.isNull() | now_.eqNullSafe(then)
    same = told & agrees(F.col("last_modified"), known("origin_modified")) & agrees(known("etag"), known("origin_etag"))
    lost = ~F.coalesce(known("answered").cast("boolean"), F.lit(True))
    archive = F.when(lost | same | (~told & fresh), "reuse").otherwise("fetch")
    choice = F.when(F.col("uploaded_at").isNull(), "fetch").when(F.coalesce(known("archive").cast("boolean"), F.lit(False)), archive).when(fresh, "fresh").when(lost, "reuse").when(F.col("last_modified").isNull() | (F.col("last_modified") <= F.col("uploaded_at")), "reuse").otherwise("fetch")
    return joined.withColumn("decision", choice)
