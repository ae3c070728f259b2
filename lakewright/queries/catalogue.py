"""Queries over the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalogue as C
from .base import OBJECTS, SNAPSHOTS, Tables, objects, query, resources, resources_prev

UUID5 = "concat(left(h, 8), '-', h[9:12], '-5', h[14:16], '-', ['8', '9', 'a', 'b'][CAST(('0x' || h[17]) AS INTEGER) % 4 + 1], h[18:20], '-', h[21:32])"
KINDS = """kinds AS (SELECT *, CASE WHEN regexp_matches(object_key, '^r[0-9]+/ducklake_') THEN CASE WHEN object_key = max(CASE WHEN regexp_matches(object_key, '^r[0-9]+/ducklake_') THEN object_key END) OVER (PARTITION BY string_split(object_key, '/')[1]) THEN 'live' ELSE 'orphan' END
  WHEN regexp_matches(object_key, '^r[0-9]+/ducklake-') OR regexp_matches(object_key, '^main/[0-9]{8}-') THEN 'orphan' ELSE 'ignored' END AS kind FROM objects)"""


@query("j4_diff_snapshots", f"WITH {SNAPSHOTS} SELECT coalesce(prev.id, cur.id) AS id, CASE WHEN prev.id IS NULL THEN 'new' WHEN cur.id IS NULL THEN 'deleted' WHEN prev.version IS DISTINCT FROM cur.version THEN 'changed' ELSE 'unchanged' END AS change FROM prev FULL JOIN cur ON prev.id = cur.id")
def j4(t: Tables) -> DataFrame:
    return C.diff_snapshots(resources_prev(t), resources(t)).select("id", "change")


@query("u4_tombstones", f"WITH {SNAPSHOTS} SELECT id FROM prev EXCEPT SELECT id FROM cur")
def u4(t: Tables) -> DataFrame:
    return C.diff_snapshots(resources_prev(t), resources(t)).filter("change = 'deleted'").select("id")


def state(t: Tables) -> DataFrame:
    old = resources_prev(t).withColumn("title", F.lit("old"))
    for c in ("first_seen", "last_changed", "last_seen"):
        old = old.withColumn(c, F.lit("s1"))
    return old.withColumn("deleted_at", F.when(F.col("id") % 17 == 0, "s0"))


def observed(t: Tables) -> DataFrame:
    return C.observe(state(t), resources(t).withColumn("title", F.lit("new")), "s2")


OBSERVED = f"""{SNAPSHOTS}, observed AS (SELECT coalesce(p.id, c.id) AS id, CASE WHEN c.id IS NULL THEN p.version ELSE c.version END AS version, CASE WHEN c.id IS NULL THEN 'old' ELSE 'new' END AS title, CASE WHEN p.id IS NULL THEN 's2' ELSE 's1' END AS first_seen,
  CASE WHEN c.id IS NOT NULL AND (p.id IS NULL OR p.id % 17 = 0 OR p.version <> c.version) THEN 's2' ELSE 's1' END AS last_changed, CASE WHEN c.id IS NULL THEN 's1' ELSE 's2' END AS last_seen, CASE WHEN c.id IS NULL AND p.id % 17 = 0 THEN 's0' END AS deleted_at
  FROM prev p FULL JOIN cur c ON p.id = c.id), after AS (SELECT * REPLACE (CASE WHEN last_seen <> 's2' AND deleted_at IS NULL THEN 's2' ELSE deleted_at END AS deleted_at), CASE WHEN id % 10 = 0 THEN 'collection' ELSE 'file' END AS kind, CASE WHEN id % 20 = 0 THEN NULL ELSE id // 20 END AS parent_id FROM observed)"""


def kinded(df: DataFrame) -> DataFrame:
    return df.withColumn("kind", F.when(F.col("id") % 10 == 0, "collection").otherwise("file")).withColumn("parent_id", F.when(F.col("id") % 20 != 0, F.floor(F.col("id") / 20)))


def done(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("resource_id"), F.lit("v1").alias("version"), F.lit("completed").alias("status"))


@query("m2_observe", f"WITH {OBSERVED} SELECT * FROM observed")
def m2(t: Tables) -> DataFrame:
    return observed(t).drop("source_id")


@query("a3_sync_counts", f"WITH {OBSERVED} SELECT count(*) FILTER (WHERE kind = 'collection' AND parent_id IS NULL AND deleted_at IS NULL) AS datasets, count(*) FILTER (WHERE kind <> 'collection' AND deleted_at IS NULL) AS resources, count(*) FILTER (WHERE kind <> 'collection' AND first_seen = 's2') AS new, count(*) FILTER (WHERE kind <> 'collection' AND last_changed = 's2' AND first_seen <> 's2') AS updated, count(*) FILTER (WHERE kind <> 'collection' AND deleted_at = 's2') AS deleted FROM after")
def a3(t: Tables) -> DataFrame:
    return C.sync_counts(kinded(C.tombstones(observed(t), "s2", "s")), "s2")


@query("m3_complete_sync", f"WITH {OBSERVED}, planned AS (SELECT id FROM after WHERE deleted_at IS NULL AND id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)) SELECT CAST(id AS VARCHAR) AS key, 'PENDING' AS kind FROM planned UNION ALL SELECT CAST(id AS VARCHAR), 'DELETED' FROM after WHERE deleted_at = 's2' UNION ALL SELECT 's', 'RESULT'")
def m3(t: Tables) -> DataFrame:
    return C.complete_sync(kinded(observed(t)), done(t), "s", "s2")[2].select("key", "kind")


@query("r6_plan_messages", f"SELECT {UUID5} AS message_id, concat('{{\"status\":\"PENDING\",\"resource_id\":\"', id, '\",\"sync_id\":\"s2\"}}') AS payload FROM (SELECT o_orderkey AS id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat('s:s2:PENDING:', o_orderkey))) AS h FROM orders)")
def r6(t: Tables) -> DataFrame:
    ids = t.orders.select(F.col("o_orderkey").alias("id"))
    return C.plan_messages("s", "s2", ids, ids.limit(0)).filter("kind = 'PENDING'").select("message_id", "payload")


@query("w2_select_snapshots", "SELECT user_id AS source_id, event_id AS sync_id, CASE WHEN event_id % 5 = 0 THEN 'imported' WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 1 THEN 'superseded' ELSE 'import' END AS decision FROM events")
def w2(t: Tables) -> DataFrame:
    headers = t.events.select(F.col("user_id").alias("source_id"), F.col("event_id").alias("sync_id"), F.col("ts").alias("collected_at"))
    return C.select_snapshots(headers, headers.filter("sync_id % 5 = 0")).select("source_id", "sync_id", "decision")


@query("t7_order_imports", "SELECT event_id FROM events ORDER BY ts, event_id")
def t7(t: Tables) -> DataFrame:
    return t.events.orderBy("ts", "event_id").select("event_id")


@query("m1_import_snapshot", f"WITH {SNAPSHOTS} SELECT coalesce(p.id, c.id) AS id, CASE WHEN c.id IS NULL THEN p.version ELSE c.version END AS version, CASE WHEN c.id IS NULL THEN 'kept' WHEN c.id % 3 = 0 THEN 'untitled' WHEN c.id % 3 = 1 THEN 'given' ELSE concat('f', c.id, '.csv') END AS title, CASE WHEN c.id IS NULL OR (p.id % 17 <> 0 AND p.version = c.version) THEN 'completed' ELSE 'discovered' END AS status, CASE WHEN c.id IS NULL THEN CASE WHEN p.id % 17 = 0 THEN 's0' ELSE 's2' END END AS deleted_at FROM prev p FULL JOIN cur c ON p.id = c.id")
def m1(t: Tables) -> DataFrame:
    old = state(t).select("source_id", "id", "version", F.lit("kept").alias("title"), F.lit("completed").alias("status"), "deleted_at")
    n = F.col("id") % 3
    rows = resources(t).select("id", "version", F.when(n == 1, "given").otherwise(" ").alias("title"), F.lit("{}").alias("metadata"), F.when(n == 2, F.concat(F.lit("http://h/a/f"), "id", F.lit(".csv?x=1"))).alias("url"))
    return C.import_snapshot(old, rows, "s", "s2").drop("source_id")


@query("u2_replace_collection", "SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN 'new' ELSE s_name END AS s_name FROM supplier")
def u2(t: Tables) -> DataFrame:
    table = t.supplier.select(F.col("s_nationkey").cast("string").alias("source_id"), "s_suppkey", "s_name")
    return C.replace_collection(table, "3", table.filter("source_id = '3'").withColumn("s_name", F.lit("new"))).select("s_suppkey", "s_name")


def tree(t: Tables) -> DataFrame:
    """Regions, their nations and the nations' customers as one tree."""
    source = F.lit("s").alias("source_id")
    top = t.region.select(source, F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("title"), F.lit("collection").alias("kind"))
    mid = t.nation.select(source, F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(" ").alias("title"), F.lit("collection").alias("kind"))
    low = t.customer.select(source, F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent_id"), F.col("c_name").alias("title"), F.lit("file").alias("kind"))
    return top.union(mid).union(low)


@query("j8_resource_paths", "SELECT c_custkey, concat(r_name, '/', CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'untitled' END, '/', c_name) AS path FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def j8(t: Tables) -> DataFrame:
    return C.resource_paths(tree(t), depth=4).filter("id LIKE 'c%'").select(F.substring("id", 2, 20).cast("long").alias("c_custkey"), F.array_join("path", "/").alias("path"))


@query("j9_available_collections", "SELECT DISTINCT unnest(CASE WHEN n_nationkey % 5 = 0 THEN [] ELSE [concat('n', n_nationkey), concat('r', n_regionkey)] END) AS id FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 9500")
def j9(t: Tables) -> DataFrame:
    rows = tree(t).withColumn("deleted_at", F.when(F.col("id").rlike("^n(0|5|10|15|20)$"), "s1"))
    tables = t.customer.filter("c_acctbal > 9500").select(F.lit("s").alias("source_id"), F.concat(F.lit("c"), "c_custkey").alias("resource_id"))
    return C.available_collections(rows, tables).select("id")


@query("m4_validate_tree", "SELECT concat('c', c_custkey) AS id, 'missing parent' AS problem FROM customer WHERE c_custkey % 100 = 7 UNION ALL SELECT concat('r', r_regionkey), 'cycle' FROM region UNION ALL SELECT concat('n', n_nationkey), 'cycle' FROM nation UNION ALL SELECT concat('c', c_custkey), 'cycle' FROM customer WHERE c_custkey % 100 <> 7")
def m4(t: Tables) -> DataFrame:
    rows = tree(t).withColumn("parent_id", F.when(F.col("id").rlike("^c.*07$") | (F.col("id") == "c7"), "nowhere").when(F.col("id").startswith("r"), F.concat(F.lit("n"), F.lit(None).cast("string"))).otherwise(F.col("parent_id")))
    first = t.nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n")).select(F.concat(F.lit("r"), "n_regionkey").alias("id"), F.concat(F.lit("n"), "n").alias("up"))
    cyclic = rows.join(first, "id", "left").withColumn("parent_id", F.coalesce("up", "parent_id")).drop("up")
    return C.validate_tree(cyclic).select("id", "problem")


@query("j6_link_tables", "SELECT CAST(p_partkey AS VARCHAR) AS table_name, CASE WHEN p_partkey % 10 = 0 THEN -p_partkey ELSE p_partkey END AS resource_id FROM part WHERE p_partkey % 10 = 0 OR p_partkey IN (SELECT s_suppkey FROM supplier)")
def j6(t: Tables) -> DataFrame:
    tables = t.part.select(F.col("p_partkey").cast("string").alias("table_name"))
    tags = t.part.filter("p_partkey % 10 = 0").select(F.col("p_partkey").cast("string").alias("table_name"), (-F.col("p_partkey")).alias("resource_id"))
    return C.link_tables(tables, tags, t.supplier.select(F.col("s_suppkey").alias("id")))


@query("j7_enrich_legacy", "SELECT concat('t', l_orderkey, '_', l_linenumber) AS table_name, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, c_name, concat('t', l_orderkey, '_', l_linenumber)) AS title, coalesce(o_orderstatus, '') AS description, c_name AS dataset FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 3 > 0 LEFT JOIN customer ON c_custkey = o_custkey")
def j7(t: Tables) -> DataFrame:
    tables = t.lineitem.select(F.concat(F.lit("t"), "l_orderkey", F.lit("_"), "l_linenumber").alias("table_name"), F.col("l_orderkey").alias("resource_id"))
    res = t.orders.filter("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("title"), F.col("o_orderstatus").alias("description"), F.col("o_custkey").alias("dataset_id"))
    return C.enrich_legacy(tables, res, t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.lit("d").alias("description")))


@query("j13_files_for_tables", "SELECT p_brand AS table_name, p_name AS file FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part ORDER BY 1 LIMIT 2) GROUP BY ALL")
def j13(t: Tables) -> DataFrame:
    names = [r[0] for r in t.part.select("p_brand").distinct().orderBy("p_brand").limit(2).collect()]
    return C.files_for_tables(t.part.select(F.col("p_brand").alias("table_name"), F.col("p_name").alias("file")), names)


@query("j14_resource_tables", "SELECT p_size AS resource_id, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS tables FROM part GROUP BY 1")
def j14(t: Tables) -> DataFrame:
    return C.resource_tables(t.part.select(F.lit("s").alias("source_id"), F.col("p_size").alias("resource_id"), F.col("p_brand").alias("table_name"))).select("resource_id", F.array_join("tables", ",").alias("tables"))


@query("u7_files_by_table", "SELECT p_brand AS table_name, count(DISTINCT p_name) FILTER (WHERE p_size % 4 > 0) AS data, count(DISTINCT p_name) FILTER (WHERE p_size % 4 = 0) AS deletes FROM part GROUP BY 1")
def u7(t: Tables) -> DataFrame:
    rows = C.files_by_table(t.part.select(F.col("p_brand").alias("table_name"), F.when(F.col("p_size") % 4 > 0, "data").otherwise("delete").alias("kind"), F.col("p_name").alias("file")))
    return rows.select("table_name", F.size("data").cast("long").alias("data"), F.size("deletes").cast("long").alias("deletes"))


@query("p8_search_catalog", "SELECT doc_id FROM documents WHERE contains(strip_accents(lower(text)), 'ecion') OR contains(strip_accents(lower(source)), 'ecion')")
def p8(t: Tables) -> DataFrame:
    return C.search_catalog(t.documents.select("doc_id", F.col("text").alias("title"), "source"), "écion").select("doc_id")


@query("p9_visible_tables", "SELECT p_partkey FROM part WHERE p_size % 3 = 0 AND p_partkey % 7 > 0 AND p_brand = 'Brand#11' AND contains(lower(p_name), 'a')")
def p9(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("source_id"), F.when(F.col("p_size") % 3 == 0, "data").otherwise("legacy").alias("category"), F.when(F.col("p_partkey") % 7 == 0, "s").alias("deleted_at"), F.lit(1).alias("parent_id"))
    return C.visible_tables(rows, "Brand#11", 1, "A").select("p_partkey")


@query("p10_split_tags", "SELECT p_partkey, concat(p_brand, '|', p_size) AS tags FROM part")
def p10(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(C.split_tags(F.concat(F.lit(" ,"), "p_brand", F.lit(" ,, "), "p_size", F.lit(","))), "|").alias("tags"))


@query("p11_categorize", "SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'metadata' WHEN p_size % 4 = 1 THEN 'data' ELSE 'legacy' END AS category FROM part")
def p11(t: Tables) -> DataFrame:
    n = F.col("p_size") % 4
    return t.part.select("p_partkey", C.categorize(F.when(n == 0, "catalog_x").otherwise(F.col("p_name")), n == 1).alias("category"))


@query("p13_select_category", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1996 AND lower(o_orderpriority) = '1-urgent'")
def p13(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("category"))
    return C.select_category(rows, 1996, "1-Urgent").select("o_orderkey")


@query("m9_register_table", "SELECT o_custkey AS resource_id, greatest(max(o_orderpriority), CASE WHEN o_custkey % 2 = 0 THEN '3-' ELSE '' END) AS version FROM orders GROUP BY o_custkey")
def m9(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("resource_id"), F.col("o_orderpriority").alias("version"), F.col("o_orderkey").alias("job_id"), F.lit("p").alias("path"))
    registry = rows.filter("resource_id % 2 = 0").select("resource_id", F.lit("3-").alias("version"), F.lit(-1).cast("long").alias("job_id"), F.lit("old").alias("path")).distinct()
    return C.register_table(registry, rows).select("resource_id", "version")


@query("m11_refresh_links", "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 > 0 AND p_partkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0) THEN 'completed' WHEN p_size % 2 = 0 THEN 'discovered' ELSE 'failed' END AS status FROM part")
def m11(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_partkey").alias("id"), F.lit("v1").alias("version"), F.when(F.col("p_size") % 2 == 0, "discovered").otherwise("failed").alias("status"), F.when(F.col("p_partkey") % 3 == 0, "s").alias("deleted_at"))
    registry = t.supplier.select(F.col("s_suppkey").alias("resource_id"), F.when(F.col("s_nationkey") % 2 == 0, "v1").otherwise("v0").alias("version"))
    return C.refresh_links(rows, registry, registry).select("id", "status")


@query("w1_classify_artifacts", f"WITH {OBJECTS}, {KINDS} SELECT object_key, kind FROM kinds")
def w1(t: Tables) -> DataFrame:
    return C.classify_artifacts(objects(t)).select("object_key", "kind")


@query("a8_storage_summary", f"WITH {OBJECTS}, {KINDS} SELECT count(*) AS objects, count(*) FILTER (WHERE kind = 'live') AS live, count(*) FILTER (WHERE kind = 'orphan') AS orphans, sum(CASE WHEN kind = 'orphan' THEN size ELSE 0 END) AS orphan_bytes FROM kinds")
def a8(t: Tables) -> DataFrame:
    return C.storage_summary(objects(t)).withColumn("orphan_bytes", F.col("orphan_bytes"))


def publications(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("source_id"), F.col("ts").alias("created_at"))


def newest(t: Tables):
    return F.lit(t.events.agg(F.max("ts")).first()[0]).cast("timestamp")


@query("w6_retained_publications", "SELECT event_id AS id FROM events WHERE event_id IN (1, 2) OR ts >= (SELECT max(ts) FROM events) - INTERVAL 2895 MINUTE")
def w6(t: Tables) -> DataFrame:
    return C.retained_publications(publications(t), 1, 2, newest(t)).select("id")


@query("w7_previous_publication", "SELECT event_id AS id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_id FROM events")
def w7(t: Tables) -> DataFrame:
    again = publications(t).withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
    return C.previous_publication(publications(t).union(again)).select("id", "previous_id")


@query("w8_expire_snapshots", "SELECT event_id AS version FROM events e WHERE event_id < (SELECT max(event_id) FROM events x WHERE x.user_id = e.user_id)")
def w8(t: Tables) -> DataFrame:
    return C.expire_snapshots(t.events.select(F.col("user_id").alias("table_id"), F.col("event_id").alias("version"))).select("version")


@query("a14_publication_health", "SELECT user_id AS source_id, CASE WHEN max(ts) < (SELECT max(ts) FROM events) - INTERVAL 36 HOUR THEN 'stale' ELSE 'fresh' END AS health FROM events GROUP BY 1")
def a14(t: Tables) -> DataFrame:
    return C.publication_health(publications(t), newest(t))


@query("u3_collections", "SELECT p_brand AS name FROM part UNION SELECT p_type FROM part")
def u3(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("name")).union(t.part.select("p_type")).distinct()


@query("u5_protected_files", f"WITH {OBJECTS} SELECT DISTINCT object_key FROM objects WHERE stamp % 3 = 0")
def u5(t: Tables) -> DataFrame:
    files = objects(t).select((F.col("stamp") % 30).alias("id"), "object_key")
    return C.protected_files(t.spark.range(0, 30, 3), files)


@query("u6_removable", f"WITH {OBJECTS}, {KINDS} SELECT object_key FROM kinds WHERE kind = 'orphan' AND stamp % 3 > 0")
def u6(t: Tables) -> DataFrame:
    return C.removable(objects(t), objects(t).filter("stamp % 3 = 0")).select("object_key")
