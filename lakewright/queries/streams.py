"""Queries over streams, state tables and sinks."""

from __future__ import annotations

import gzip
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators.schema import merge_children
from ..operators.statistics import file_footers
from ..plans.folders import shared_folder
from ..plans.state import Registry, StateTable
from ..sinks import files as K
from ..sources.archives import list_objects
from ..sources.messages import write_messages
from ..streaming import jobs as R
from .base import OBJECTS, Tables, messages, objects, query
from .catalogue import KINDS
from .ledger import FOLD, children


def _run(stream: DataFrame, folder: str) -> DataFrame:
    """Drain a stream into Parquet files and read them."""
    query_ = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query_.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def _streamed(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(f"{folder}/in")
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{folder}/in")


@query("r1_job_state_stream", f"WITH {FOLD} SELECT event_id, job_id, CASE status WHEN 'SUCCESS' THEN 'completed' WHEN 'FAILED' THEN 'failed' ELSE 'deleted' END AS status FROM fold")
def r1_stream(t: Tables) -> DataFrame:
    folder = shared_folder(t.spark, "jobs")
    rows = messages(t).select("event_id", "ts", "resource_id", "job_id", "status")
    stream = R.job_state_stream(R.deduplicated(_streamed(rows.union(rows), folder)))
    return _run(stream, folder).filter(F.col("status").isin("completed", "failed", "deleted")).select("event_id", "job_id", "status")


@query("r4_child_completion_stream", "SELECT l_orderkey AS parent_job_id, CASE WHEN bool_or(l_discount < 0.01) THEN 'failed' ELSE 'completed' END AS status FROM lineitem GROUP BY 1 HAVING bool_or(l_discount < 0.01) OR count(DISTINCT l_linenumber % 4) = 4")
def r4_stream(t: Tables) -> DataFrame:
    folder = shared_folder(t.spark, "children")
    rows = children(t).select("parent_job_id", "child_index", "status", "total_child_count")
    return _run(R.child_completion_stream(_streamed(rows, folder)), folder)


@query("r8_deduplicated_stream", "SELECT event_id, value FROM events")
def r8_stream(t: Tables) -> DataFrame:
    """Every event twice, with a memory of the days that the events span."""
    folder = shared_folder(t.spark, "dedup")
    span = t.events.agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    rows = t.events.select("event_id", "ts", "value")
    return _run(R.deduplicated(_streamed(rows.union(rows), folder), watermark=f"{span + 1} days"), folder).select("event_id", "value")


@query("r1_retained_state_stream", f"WITH {FOLD} SELECT event_id, job_id, CASE status WHEN 'SUCCESS' THEN 'completed' WHEN 'FAILED' THEN 'failed' ELSE 'deleted' END AS status FROM fold")
def r1_retained(t: Tables) -> DataFrame:
    """As r1_job_state_stream, with jobs that are forgotten after the days that the events span."""
    folder = shared_folder(t.spark, "jobs")
    span = t.events.agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    rows = messages(t).select("event_id", "ts", "resource_id", "job_id", "status")
    stream = R.job_state_stream(_streamed(rows, folder), f"{span + 1} days")
    return _run(stream, folder).filter(F.col("status").isin("completed", "failed", "deleted")).select("event_id", "job_id", "status")


@query("r10_sync_state_stream", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 > 0 THEN 'running' WHEN o_orderkey % 2 = 0 THEN 'completed' ELSE 'failed' END AS status FROM orders")
def r10_stream(t: Tables) -> DataFrame:
    """Results of two streams into one table, one of them run twice."""
    folder = shared_folder(t.spark, "syncs")
    table = StateTable(t.spark, f"{folder}/state", "id long, instance_id long, status string, count int, error string")
    table.update(lambda _: t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("instance_id"), F.lit("running").alias("status"), F.lit(0).alias("count"), F.lit(None).cast("string").alias("error")))
    results = t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("sync_id"), (F.col("o_orderkey") % 2 == 0).alias("success"), F.lit("e").alias("error"), F.lit(7).alias("count"))
    sources = {name: _streamed(results.filter(part), f"{folder}/{name}") for name, part in (("good", "success"), ("bad", "NOT success"))}
    for name in ("good", "bad", "good"):
        R.sync_state_stream(sources[name], table, f"{folder}/{name}/checkpoint", name).awaitTermination()
    return table.read().select("id", "status")


@query("r11_message_sink", "SELECT CAST(user_id AS VARCHAR) AS key, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events")
def r11(t: Tables) -> DataFrame:
    """Events as messages by user, in two appends; offsets keep the order of a user's events."""
    from pyspark.sql.window import Window

    from ..sources.messages import read_messages

    folder = shared_folder(t.spark, "sink")
    rows = t.events.select(F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id")).alias("value"), "event_id")
    half = rows.agg(F.percentile("event_id", 0.5)).first()[0]
    rows.filter(F.col("event_id") <= half).write.parquet(f"{folder}/in/1")
    for number, part in ((1, None), (2, F.col("event_id") > half)):
        if part is not None:
            rows.filter(part).write.parquet(f"{folder}/in/{number}")
        stream = t.spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        R.write_stream(stream, f"{folder}/messages", f"{folder}/checkpoint", "event_id").awaitTermination()
    place = F.row_number().over(Window.partitionBy("key").orderBy("offset"))
    return read_messages(t.spark, f"{folder}/messages", "event_id long").select("key", "event_id", place.alias("place"))


@query("m9_registry", "SELECT o_custkey AS resource_id, max(o_orderpriority) AS version FROM orders GROUP BY 1")
def m9_registry(t: Tables) -> DataFrame:
    registry = Registry(t.spark, shared_folder(t.spark, "lake"))
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("resource_id"), F.col("o_orderpriority").alias("version"), F.col("o_orderkey").cast("string").alias("job_id"), F.lit("p").alias("path"))
    for priority in ("3", "1", "5", "2", "4", "5"):
        registry.register(rows.filter(F.col("version").startswith(priority)))
    return registry.state.read().select(F.col("resource_id").cast("long").alias("resource_id"), "version")


@query("m10_register_children", "SELECT o_orderkey AS id, 'a.csv' AS __source_file FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'b.csv' FROM orders WHERE o_orderkey % 2 = 1")
def m10(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "lake")
    registry = Registry(t.spark, root)
    half = lambda n: t.orders.filter(f"o_orderkey % 2 = {n}").select(F.col("o_orderkey").alias("id"))
    path = K.write_table(merge_children([("a.csv", half(0)), ("b.csv", half(1))]), root, "parent", "v1")
    registry.register(t.spark.createDataFrame([("parent", "v1", "j", path)], Registry.SCHEMA))
    return registry.table("parent")


@query("m16_rebuild_registry", "SELECT concat('r', p_size) AS resource_id, lpad(CAST(max(p_partkey) AS VARCHAR), 8, '0') AS version FROM part WHERE p_partkey % 10 < 7 GROUP BY 1")
def m16(t: Tables) -> DataFrame:
    registry = Registry(t.spark, shared_folder(t.spark, "lake"))
    registry.rebuild(objects(t))
    return registry.state.read().select("resource_id", "version")


@query("s17_scan_inbox", "SELECT n_regionkey AS source_id, 's1' AS sync_id, n_nationkey AS id, n_name AS title FROM nation")
def s17(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "inbox")
    for r in t.region.collect():
        rows = t.nation.filter(F.col("n_regionkey") == r["r_regionkey"]).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"))
        header = {"source_id": str(r["r_regionkey"]), "sync_id": "s1", "collected_at": "2024-01-01T00:00:00Z", "resources_total": 5}
        K.write_snapshot(header, rows, root)
        K.write_snapshot(header, rows.limit(0), root)  # the first one stays
    headers, body = K.scan_inbox(t.spark, root, "id long, title string")
    return body.join(headers.select("source_id", "sync_id"), ["source_id", "sync_id"]).select(F.col("source_id").cast("int").alias("source_id"), "sync_id", "id", "title")


@query("k1_write_table", "SELECT p_partkey AS a, p_name AS a__2, NULL::VARCHAR AS nothing FROM part")
def k1(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "lake")
    return t.spark.read.parquet(K.write_table(t.part.select("p_partkey", "p_name", F.lit(None)).toDF("a", "A", "nothing").toDF("a", "a", "nothing"), root, "r1", "v1"))


@query("k3_member_keys", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS name, 'v1' AS version FROM pages")
def k3(t: Tables) -> DataFrame:
    key = F.split(K.member_key(F.lit("http://h/a.zip"), F.lit("v1"), F.col("url")), "/")
    return t.pages.select("page_id", key[2].alias("name"), key[1].alias("version"))


@query("k4_export", "SELECT event_id, value FROM events")
def k4(t: Tables) -> DataFrame:
    """All events, exported and read back."""
    path = shared_folder(t.spark, "export")
    K.export(t.events.select("event_id", "value"), "csv", path, limit=None)
    return t.spark.read.option("header", True).schema("event_id long, value double").csv(path)


@query("j12_build_manifest", "SELECT 'nation' AS table_name, count(*) AS n_rows, 3 AS n_columns, 'Nations' AS title, 'n1,n2' AS files FROM nation UNION ALL SELECT 'region', count(*), 2, NULL, NULL FROM region")
def j12(t: Tables) -> DataFrame:
    files = t.spark.createDataFrame([("nation", "n1"), ("nation", "n2")], "table_name string, file string")
    titles = t.spark.createDataFrame([("nation", "Nations")], "table_name string, title string")
    rows = K.build_manifest({"nation": t.nation, "region": t.region}, files, titles)
    return rows.select("table_name", "n_rows", F.size("columns").alias("n_columns"), "title", F.array_join("files", ",").alias("files"))


@query("k6_publish", f"WITH {OBJECTS} SELECT DISTINCT object_key FROM objects")
def k6(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "published")
    files = objects(t).select(F.lit("part").alias("table_name"), F.col("object_key").alias("file"))
    manifest = K.build_manifest({"part": t.part}, files, t.spark.createDataFrame([("part", "Parts")], "table_name string, title string"))
    K.publish(manifest, root, "p1")
    return t.spark.read.parquet(f"{root}/publications/p1/protected")


@query("k7_copy_catalog", "SELECT s_suppkey, s_name FROM supplier")
def k7(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "catalog")
    table = StateTable(t.spark, f"{root}/suppliers", "s_suppkey long, s_name string")
    table.update(lambda _: t.supplier.select("s_suppkey", "s_name"))
    K.copy_catalog({"suppliers": table}, f"{root}/copy")
    return t.spark.read.parquet(f"{root}/copy/suppliers")


@query("k2_write_geo_table", "SELECT count(*) AS n_rows, 'geometry' AS primary_column, 'WKB' AS encoding, '[\"LineString\",\"Point\"]' AS kinds, least(min(s_suppkey), 1)::DOUBLE AS west, -2.5::DOUBLE AS south, max(s_suppkey)::DOUBLE AS east, max(s_nationkey)::DOUBLE AS north, min(s_suppkey) AS least_id, sum(CASE WHEN s_suppkey % 2 = 0 THEN 21 ELSE 41 END)::BIGINT AS bytes FROM supplier")
def k2(t: Tables) -> DataFrame:
    """Suppliers as points and lines; kinds and bounds from the footers of the files."""
    point = F.concat(F.lit('{"type":"Point","coordinates":['), "s_suppkey", F.lit(","), "s_nationkey", F.lit("]}"))
    line = F.concat(F.lit('{"type":"LineString","coordinates":[[1,-2.5],['), "s_suppkey", F.lit(","), "s_nationkey", F.lit("]]}"))
    shapes = t.supplier.repartition(3, "s_suppkey").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 == 0, point).otherwise(line).alias("geometry"))
    path = K.write_geo_table(shapes, shared_folder(t.spark, "geo"), "r1", "v1", {"version": "1.1.0", "primary_column": "geometry"})
    geo = F.from_json(F.element_at("metadata", "geo"), "primary_column string, columns struct<geometry: struct<encoding: string, geometry_types: array<string>, bbox: array<double>>>")
    files = file_footers(t.spark, path).select("n_rows", geo.alias("g")).select("n_rows", "g.primary_column", "g.columns.geometry.*")
    side = lambda i, f: f(F.get("bbox", F.lit(i)))
    kinds = F.to_json(F.array_sort(F.array_distinct(F.flatten(F.collect_list("geometry_types")))))
    figures = files.agg(F.sum("n_rows").alias("n_rows"), F.max("primary_column").alias("primary_column"), F.max("encoding").alias("encoding"), kinds.alias("kinds"), side(0, F.min).alias("west"), side(1, F.min).alias("south"), side(2, F.max).alias("east"), side(3, F.max).alias("north"))
    rows = t.spark.read.parquet(path).agg(F.min("id").alias("least_id"), F.sum(F.octet_length("geometry")).alias("bytes"))
    return figures.join(rows)  # a row each


@query("k5_write_snapshot", "SELECT '7' AS source_id, 's9' AS sync_id, '2024-01-01T00:00:00Z' AS collected_at, s_suppkey AS id, s_name AS title FROM supplier")
def k5(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "snapshots")
    rows = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    header = {"source_id": "7", "sync_id": "s9", "collected_at": "2024-01-01T00:00:00Z", "resources_total": t.supplier.count()}
    if not K.write_snapshot(header, rows, root) or K.write_snapshot(header, rows.select("id"), root):
        raise ValueError("a snapshot is written once")
    headers, body = K.scan_inbox(t.spark, root, "id long, title string")
    return body.join(headers.drop("resources_total"), ["source_id", "sync_id"])


@query("k8_registration_plan", f"WITH {OBJECTS}, {KINDS} SELECT object_key AS path, (row_number() OVER (ORDER BY object_key) - 1) // 10 + 1 AS batch FROM kinds WHERE kind = 'live'")
def k8(t: Tables) -> DataFrame:
    return K.registration_plan(objects(t), 10)[0].select("path", "batch")


RECORD = r"concat('WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: ', url, '\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: ', octet_length(encode(html)), '\r\n\r\n', html, '\r\n\r\n')".replace("\\r\\n", "' || chr(13) || chr(10) || '")


@query("k9_archive_pages", f"SELECT concat('captures/', sha256(concat_ws('|', url, html)), '.warc.gz') AS key, sha256({RECORD}) AS record FROM pages")
def k9(t: Tables) -> DataFrame:
    """Digests of the records as they are unpacked."""

    def unpack(frames):
        for df in frames:
            yield df.assign(record=[hashlib.sha256(gzip.decompress(p)).hexdigest() for p in df["payload"]])[["key", "record"]]

    return K.archive_pages(t.pages, "2024-01-01T00:00:00Z").mapInPandas(unpack, "key string, record string")
