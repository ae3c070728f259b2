"""Sinks: resource tables, exports, snapshots, publications, registration plans and page captures."""

from __future__ import annotations

import gzip
import json
import math
import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import stable_id
from ..operators.catalogue import classify_artifacts
from ..operators.explore import BOUND, number_batches
from ..operators.schema import arrow_schema, assign_field_ids, normalize_names, normalize_nulls
from ..operators.statistics import column_statistics
from ..plans.folders import file_system, publish_file, shared_folder, stored

ROW_GROUP = 8 << 20


def write_table(df: DataFrame, root: str, resource: str, version: str) -> str:
    """A resource's table as Parquet with row groups of about 8 MiB and valid names; returns its path."""
    return _write(normalize_nulls(normalize_names(df)), f"{root}/{resource}/ducklake_{version}.parquet")


def _write(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)
    return path


def write_files(df: DataFrame, path: str, metadata: dict[str, str] | None = None, geometry: str | None = None) -> DataFrame:
    """Write Parquet files with what Spark's writer leaves out: field ids at every level, and key-value metadata in each footer.

    A partition is a file, which appears under its number when it is complete,
    so a task that runs twice changes nothing.  With a ``geometry`` column of
    GeoJSON texts, that is written as well-known binary, and the footer's
    ``geo`` tells the kinds and bounds of the file's own shapes.  Returns, once
    the files are there, (file, n_rows, kinds, bounds) of each.
    """
    schema = arrow_schema(assign_field_ids(df.schema))
    if geometry is not None:
        at = schema.get_field_index(geometry)
        schema = schema.set(at, schema.field(at).with_type(pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(path)
        fs.create_dir(base, recursive=True)
        number = TaskContext.get().partitionId()
        temporary, target = f"{base}/.{uuid.uuid4().hex}.tmp", f"{base}/part-{number:05d}.parquet"
        rows, kinds, bounds = 0, set(), [math.inf, math.inf, -math.inf, -math.inf]
        with fs.open_output_stream(temporary) as out, pq.ParquetWriter(out, schema) as writer:
            for batch in batches:
                if geometry is not None:
                    shapes = [None if text is None else json.loads(text) for text in batch.column(at).to_pylist()]
                    for shape in filter(None, shapes):
                        kinds.add(shape["type"])
                        for x, y, *_ in positions(shape):
                            bounds = [min(bounds[0], x), min(bounds[1], y), max(bounds[2], x), max(bounds[3], y)]
                    batch = batch.set_column(at, geometry, pa.array([None if s is None else well_known_binary(s) for s in shapes], pa.binary()))
                rows += batch.num_rows
                writer.write_table(pa.Table.from_batches([batch]).cast(schema), row_group_size=max(1, ROW_GROUP * batch.num_rows // max(1, batch.nbytes)))
            found = bounds if bounds[0] <= bounds[2] else None
            writer.add_key_value_metadata({k: _with_bounds(v, geometry, kinds, found) if k == "geo" else v for k, v in (metadata or {}).items()})
        fs.move(temporary, target)
        yield pa.RecordBatch.from_pylist([{"file": target, "n_rows": rows, "kinds": sorted(kinds), "bounds": found}], schema=report)

    report = pa.schema([("file", pa.string()), ("n_rows", pa.int64()), ("kinds", pa.list_(pa.string())), ("bounds", pa.list_(pa.float64()))])
    files = stored(df.mapInArrow(run, "file string, n_rows long, kinds array<string>, bounds array<double>"), f"{shared_folder(df.sparkSession, 'written')}/files")
    if not files.isEmpty():
        return files
    # a table without partitions is a file without rows
    return stored(df.sparkSession.range(1).coalesce(1).mapInArrow(lambda _: run(iter(())), files.schema), f"{shared_folder(df.sparkSession, 'written')}/files")


def _with_bounds(geo: str, geometry: str, kinds: Iterable[str], bounds: list[float] | None) -> str:
    """Geographic metadata with the kinds and bounds of the shapes that it stands for."""
    held = json.loads(geo)
    column = {"encoding": "WKB", **held.get("columns", {}).get(geometry, {}), "geometry_types": sorted(kinds)} | ({"bbox": bounds} if bounds else {})
    return json.dumps({"version": "1.1.0", "primary_column": geometry, **held, "columns": {**held.get("columns", {}), geometry: column}})


def positions(shape: dict) -> Iterator[Sequence[float]]:
    """All positions of a GeoJSON geometry."""
    for part in shape.get("geometries", []):
        yield from positions(part)
    nested = [shape.get("coordinates", [])]
    while nested:
        some = nested.pop()
        if some and not isinstance(some[0], list):
            yield some
        else:
            nested.extend(some)


# Geometry codes of well-known binary, and what their parts are.
WKB_CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}
WKB_PARTS = {"MultiPoint": "Point", "MultiLineString": "LineString", "MultiPolygon": "Polygon"}


def well_known_binary(shape: dict) -> bytes:
    """A GeoJSON geometry in two dimensions, or three if its first position has them."""
    deep = len(next(iter(positions(shape)), ())) > 2
    number = lambda n: n.to_bytes(4, "little")
    place = lambda p: struct.pack("<3d" if deep else "<2d", *(p[:3] if deep else p[:2]))
    line = lambda ps: number(len(ps)) + b"".join(map(place, ps))

    def whole(kind: str, held: list) -> bytes:
        head = b"\x01" + number(WKB_CODES[kind] + (1000 if deep else 0))
        if kind == "Point":
            return head + (place(held) if held else place([math.nan] * 3))
        if kind == "LineString":
            return head + line(held)
        if kind == "Polygon":
            return head + number(len(held)) + b"".join(map(line, held))
        if kind == "GeometryCollection":
            return head + number(len(held)) + b"".join(whole(g["type"], g.get("geometries", g.get("coordinates"))) for g in held)
        return head + number(len(held)) + b"".join(whole(WKB_PARTS[kind], part) for part in held)

    return whole(shape["type"], shape.get("geometries", shape.get("coordinates")))


def write_geo_table(df: DataFrame, root: str, resource: str, version: str, geo: dict, geometry: str = "geometry") -> str:
    """As ``write_table``, with ``geo`` in the footer of every file, and that of the whole table, its bounds over all files, beside it."""
    path = f"{root}/{resource}/ducklake_{version}.parquet"
    files = write_files(normalize_nulls(normalize_names(df)), path, {"geo": json.dumps(geo)}, geometry)
    corner = lambda i, f: f(F.get("bounds", F.lit(i)))
    whole = files.agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("kinds")))).alias("kinds"), F.array(*[corner(i, F.min if i < 2 else F.max) for i in range(4)]).alias("bounds")).first()
    bounds = None if whole["bounds"][0] is None else list(whole["bounds"])
    text = _with_bounds(json.dumps(geo), geometry, whole["kinds"], bounds)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{resource}/geo_{version}")
    return path


def member_key(source: Column, version: Column, name: Column) -> Column:
    """Object key of a crawled member: a stable id of the source, its version, and the member's name."""
    return F.concat_ws("/", stable_id(source), version, F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_"))


def export(df: DataFrame, kind: str, path: str, limit: int | None = BOUND) -> None:
    """At most ``limit`` rows, or all if it is None, as CSV with a header, or as Parquet."""
    if kind not in ("csv", "parquet"):
        raise ValueError(f"not an export format: {kind}")
    rows = df if limit is None else df.limit(limit)
    rows.write.option("header", True).csv(path) if kind == "csv" else rows.write.parquet(path)


def write_snapshot(header: dict, rows: DataFrame, root: str) -> bool:
    """A source's snapshot: a header line, then one JSON line a row, in one file; False if that sync's is there already.

    Tasks write the rows in parts, one task copies them, a piece at a time,
    behind the header, and the file then gets its name at once; of two writers
    one wins, and the other changes nothing.
    """
    spark = rows.sparkSession
    target = f"{root}/{header['source_id']}/{header['sync_id']}.jsonl"
    path = spark._jvm.org.apache.hadoop.fs.Path
    if path(target).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(target)):
        return False
    folder = shared_folder(spark, "snapshot")
    rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("value")).write.text(f"{folder}/parts")
    temporary = f"{root}/{header['source_id']}/.{header['sync_id']}-{uuid.uuid4().hex}"
    first = json.dumps({"version": 1, **header}) + "\n"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            fs, parts = file_system(f"{folder}/parts")
            out_fs, place = file_system(temporary)
            out_fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
            names = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(parts)) if f.base_name.startswith("part-"))
            with out_fs.open_output_stream(place) as out:
                out.write(first.encode())
                for name in names:
                    with fs.open_input_stream(name) as part:
                        while data := part.read(8 << 20):
                            out.write(data)
            yield df

    spark.range(1).coalesce(1).mapInPandas(run, "id long").count()
    return publish_file(spark, temporary, target)


def scan_inbox(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(headers, resources) of all snapshots <source>/<sync>.jsonl below a root.

    A header has version 1, the identity of its path, and a count that is not
    negative; anything else fails the import.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(root).filter(F.trim("value") != "")
    key = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+/[^/]+\.jsonl)(?:/|$)", 1)
    rows = lines.select(F.try_url_decode(F.split_part(key, F.lit("/"), F.lit(1))).alias("source_id"), F.regexp_replace(F.split_part(key, F.lit("/"), F.lit(2)), r"\.jsonl$", "").alias("sync_id"), "value")
    is_header = F.get_json_object("value", "$.sync_id").isNotNull() & F.get_json_object("value", "$.version").isNotNull()
    h = F.from_json("value", "version int, source_id string, sync_id string, collected_at string, resources_total long")
    ok = (F.col("h.version") == 1) & (F.col("h.source_id") == F.col("source_id")) & (F.col("h.sync_id") == F.col("sync_id")) & (F.col("h.resources_total") >= 0)
    headers = rows.filter(is_header).withColumn("h", h).select("source_id", "sync_id", F.when(ok, F.col("h.collected_at")).otherwise(F.raise_error(F.concat(F.lit("bad header of "), "sync_id"))).alias("collected_at"), F.col("h.resources_total").alias("resources_total"))
    body = rows.filter(~is_header).select("source_id", "sync_id", F.from_json("value", schema).alias("r")).select("source_id", "sync_id", "r.*")
    return headers, body


def build_manifest(tables: dict[str, DataFrame], files: DataFrame, titles: DataFrame) -> DataFrame:
    """One row a table: title, columns with statistics, rows, and files (files: table_name, file; titles: table_name, title)."""
    from functools import reduce

    def one(name: str, df: DataFrame) -> DataFrame:
        return column_statistics(df).groupBy(F.lit(name).alias("table_name")).agg(F.max("n_rows").alias("n_rows"), F.array_sort(F.collect_list(F.struct("column", "nulls"))).alias("columns"))

    rows = reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])
    lists = files.groupBy("table_name").agg(F.array_sort(F.collect_set("file")).alias("files"))
    return rows.join(lists, "table_name", "left").join(titles, "table_name", "left")


def publish(manifest: DataFrame, root: str, publication: str) -> None:
    """Write a publication: its manifest and index of files, checked, and last the pointer to it."""
    from ..plans.manifests import Manifests

    spark = manifest.sparkSession
    held = stored(manifest, f"{shared_folder(spark, 'manifest')}/rows")
    held.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/publications/{publication}/manifest")
    held.select(F.explode("files").alias("object_key")).distinct().write.parquet(f"{root}/publications/{publication}/protected")
    written = spark.read.text(f"{root}/publications/{publication}/manifest").count()
    if written != held.count():
        raise ValueError("the manifest is not complete")
    pointer = Manifests(spark, f"{root}/latest")
    base = pointer.newest()
    if not base or pointer.read(base)["publication"] != publication:
        pointer.commit(base, {"publication": publication, "previous": pointer.read(base)["publication"] if base else None})


def copy_catalog(states: dict, dest: str) -> dict:
    """Copy state tables at the versions that are newest now; returns those versions."""
    versions = {name: table.manifests.newest() for name, table in states.items()}
    for name, table in states.items():
        table.read(versions[name]).write.mode("overwrite").parquet(f"{dest}/{name}")
    return versions


def registration_plan(objects: DataFrame, size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(live artifacts with table name, path and batch number, orphan paths)."""
    kinds = classify_artifacts(objects)
    live = kinds.filter("kind = 'live'").select(F.element_at(F.split("folder", "/"), -1).alias("table_name"), F.col("object_key").alias("path"))
    return number_batches(live, "path", size), kinds.filter("kind = 'orphan'").select(F.col("object_key").alias("path"))


#: Bytes of pages whose records go out together.
CAPTURE_BYTES = 8 << 20


def capture_batches(frames: Iterable[pd.DataFrame], date: str) -> Iterator[pd.DataFrame]:
    """Frames (key, payload) of pages (key, url, html), of about CAPTURE_BYTES of pages or one page each."""
    for df in frames:
        out, size = [], 0
        for key, url, body in zip(df["key"], df["url"], df["html"], strict=True):
            data = (body or "").encode()
            head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nContent-Type: text/html\r\nContent-Length: {len(data)}\r\n\r\n"
            out.append((key, gzip.compress(head.encode() + data + b"\r\n\r\n", mtime=0)))
            size += len(data)
            if size > CAPTURE_BYTES:
                yield pd.DataFrame(out, columns=["key", "payload"])
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["key", "payload"])


def archive_pages(pages: DataFrame, date: str) -> DataFrame:
    """(key, payload) of pages (url, html): a gzip member with one WARC record each, under an immutable key by content."""

    key = F.concat(F.lit("captures/"), F.sha2(F.concat_ws("|", "url", "html"), 256), F.lit(".warc.gz"))
    return pages.select("url", "html", key.alias("key")).mapInPandas(lambda frames: capture_batches(frames, date), "key string, payload binary")


def check_members(names: Sequence[str], most: int = 50) -> None:
    if len(set(names)) > most:
        raise ValueError(f"at most {most} tables")
