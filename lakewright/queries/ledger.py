"""Queries over the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ledger as L
from .base import JOBS, MESSAGES, Tables, jobs, messages, query

INSTANCES = "instances AS (SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_regionkey = 0 THEN 'archive' ELSE 'portal' END AS source_type FROM nation)"
LABELS = "labels AS (SELECT DISTINCT l_orderkey % 500 AS resource_id, CASE WHEN l_quantity < 5 THEN 'empty' ELSE concat('mode:', l_returnflag) END AS label FROM lineitem)"
LATEST = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY created_at DESC, id DESC) AS k FROM jobs WHERE parent_job_id IS NULL) WHERE k = 1)"
FOLD = f"""{MESSAGES}, m1 AS (SELECT *, max(CASE WHEN status = 'PENDING' THEN 1 END) OVER w AS begun, count(CASE WHEN status = 'PROCESSING' THEN 1 END) OVER w AS epoch FROM messages WINDOW w AS (PARTITION BY job_id ORDER BY ts, event_id)),
fold AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id, epoch ORDER BY ts, event_id) AS k FROM m1 WHERE begun = 1 AND status IN ('SUCCESS', 'FAILED', 'DELETED')) WHERE k = 1)"""
COUNTS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in L.STATUSES)
EMPTY = "count(*) FILTER (WHERE latest.resource_id IN (SELECT resource_id FROM labels WHERE label = 'empty')) AS empty"


def instances(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_regionkey") == 0, "archive").otherwise("portal").alias("source_type"))


def labels(t: Tables) -> DataFrame:
    label = F.when(F.col("l_quantity") < 5, "empty").otherwise(F.concat(F.lit("mode:"), "l_returnflag"))
    return t.lineitem.select((F.col("l_orderkey") % 500).alias("resource_id"), label.alias("label")).distinct()


@query("p5_list_jobs", f"WITH {JOBS}, {INSTANCES} SELECT jobs.id, name AS instance_name, status FROM jobs LEFT JOIN instances i ON i.id = instance_id WHERE parent_job_id IS NULL AND status = 'completed'")
def p5(t: Tables) -> DataFrame:
    return L.list_jobs(jobs(t), instances(t), status="completed").select("id", "instance_name", "status")


@query("p6_list_resources", "SELECT p_partkey FROM part WHERE p_name LIKE '%a_e%' OR p_brand LIKE '%a_e%' OR CAST(p_partkey AS VARCHAR) LIKE '%a_e%'")
def p6(t: Tables) -> DataFrame:
    from ..functions.scalars import like_any

    return t.part.filter(like_any("a_e", F.col("p_name"), F.col("p_brand"), F.col("p_partkey").cast("string"))).select("p_partkey")


@query("p12_plan_candidates", "SELECT p_partkey AS resource_id FROM part WHERE p_size % 4 <> 0 AND p_size % 5 <> 0 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.095)")
def p12(t: Tables) -> DataFrame:
    resources = t.part.select(F.col("p_partkey").alias("resource_id"), F.when(F.col("p_size") % 4 == 0, "").otherwise("http://x").alias("url"), F.when(F.col("p_size") % 5 != 0, "v1").alias("version"))
    done = t.lineitem.select(F.col("l_partkey").alias("resource_id"), F.lit("v1").alias("version"), F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.095), "completed").otherwise("failed").alias("status"))
    return L.pending_versions(resources, done).select("resource_id")


@query("j5_pending_versions", "SELECT o_orderkey AS resource_id, o_orderstatus AS version FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = o_orderstatus AND l_tax > 0.05)")
def j5(t: Tables) -> DataFrame:
    resources = t.orders.select(F.col("o_orderkey").alias("resource_id"), F.lit("u").alias("url"), F.col("o_orderstatus").alias("version"))
    done = t.lineitem.select(F.col("l_orderkey").alias("resource_id"), F.col("l_linestatus").alias("version"), F.when(F.col("l_tax") > 0.05, "completed").otherwise("failed").alias("status"))
    return L.pending_versions(resources, done).select("resource_id", "version")


@query("p14_validate_results", "SELECT CASE WHEN event_type = 'click' THEN 'rejected' WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'ignored' WHEN event_id % 2 = 0 THEN 'rejected' ELSE 'valid' END AS kind, count(*) AS n FROM events GROUP BY 1")
def p14(t: Tables) -> DataFrame:
    rows = messages(t).select("event_id", "resource_id", F.when(F.col("event_id") % 2 == 1, F.col("job_id")).alias("job_id"), F.when(F.col("status") != "DELETED", F.col("status")).otherwise("UNKNOWN").alias("status"))
    valid, ignored, rejected = L.validate_results(rows)
    named = lambda df, kind: df.groupBy(F.lit(kind).alias("kind")).agg(F.count("*").alias("n"))
    return named(valid, "valid").union(named(ignored, "ignored")).union(named(rejected, "rejected"))


@query("p15_list_syncs", f"WITH {INSTANCES} SELECT o_orderkey AS id, name AS instance_name, o_totalprice AS count FROM orders LEFT JOIN instances i ON i.id = o_custkey % 25 WHERE o_custkey % 25 = 3")
def p15(t: Tables) -> DataFrame:
    syncs = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("instance_id"), F.col("o_orderdate").alias("start_time"), F.col("o_totalprice").alias("count"))
    return L.list_syncs(syncs, instances(t), 3).select("id", "instance_name", "count")


@query("j2_with_labels", f"WITH {LABELS} SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM labels WHERE resource_id = o_orderkey AND label IN ('empty', 'mode:R'))")
def j2(t: Tables) -> DataFrame:
    return L.with_labels(t.orders.withColumnRenamed("o_orderkey", "resource_id"), labels(t), ["empty", "mode:R"]).select(F.col("resource_id").alias("o_orderkey"))


@query("j3_job_counts", f"WITH {JOBS} SELECT c_custkey AS resource_id, (SELECT count(*) FROM jobs WHERE resource_id = c_custkey) AS n_jobs FROM customer")
def j3(t: Tables) -> DataFrame:
    return L.job_counts(t.customer.select(F.col("c_custkey").alias("resource_id")), jobs(t))


@query("a1_dataset_rollup", f"WITH {JOBS}, {LABELS}, {LATEST} SELECT instance_id, dataset_name, count(*) AS total, {COUNTS}, {EMPTY}, max(created_at) AS updated_at FROM latest GROUP BY 1, 2")
def a1(t: Tables) -> DataFrame:
    return L.dataset_rollup(L.latest_resource(jobs(t)), labels(t))


@query("p7_list_datasets", f"WITH {JOBS}, {LABELS}, {LATEST} SELECT instance_id, dataset_name, count(*) AS total FROM latest WHERE dataset_name LIKE '%URG%' GROUP BY 1, 2")
def p7(t: Tables) -> DataFrame:
    return L.dataset_rollup(L.latest_resource(jobs(t)), labels(t), "URG").select("instance_id", "dataset_name", "total")


@query("a2_dashboard", f"WITH {JOBS}, {LABELS}, {LATEST}, {INSTANCES} SELECT i.id, name, count(latest.id) AS total, {COUNTS}, {EMPTY} FROM instances i LEFT JOIN latest ON instance_id = i.id AND instance_id % 3 > 0 GROUP BY 1, 2")
def a2(t: Tables) -> DataFrame:
    return L.dashboard(instances(t), L.latest_resource(jobs(t)).filter("instance_id % 3 > 0"), labels(t))


@query("a6_instance_counts", f"WITH {JOBS}, {LATEST} SELECT instance_id, count(DISTINCT dataset_name) AS datasets, count(*) AS resources FROM latest GROUP BY 1")
def a6(t: Tables) -> DataFrame:
    return L.instance_counts(L.latest_resource(jobs(t)))


@query("a9_labels_by_resource", f"WITH {LABELS} SELECT resource_id, string_agg(label, ',' ORDER BY label) AS labels FROM labels GROUP BY 1")
def a9(t: Tables) -> DataFrame:
    return L.labels_by_resource(labels(t)).select("resource_id", F.array_join("labels", ",").alias("labels"))


@query("w3_latest_resource", f"WITH {JOBS}, {LATEST} SELECT resource_id, id, status, created_at FROM latest")
def w3(t: Tables) -> DataFrame:
    return L.latest_resource(jobs(t)).select("resource_id", "id", "status", "created_at")


@query("w4_terminal_state", f"WITH {FOLD} SELECT resource_id, arg_max(job_id, (ts, event_id)) AS last_terminal_job, arg_max(status, (ts, event_id)) AS last_terminal_status, max(ts) AS last_terminal_at, arg_max(job_id, (ts, event_id)) FILTER (WHERE status = 'SUCCESS') AS last_successful_job FROM fold GROUP BY 1")
def w4(t: Tables) -> DataFrame:
    return L.terminal_state(messages(t))


CHILDREN = "kids AS (SELECT l_orderkey AS parent_job_id, l_linenumber % 4 AS child_index, CASE WHEN l_discount < 0.01 THEN 'FAILED' ELSE 'SUCCESS' END AS status, l_shipdate AS ts, l_partkey * 10 + l_linenumber AS event_id, 4 AS total_child_count FROM lineitem)"


def children(t: Tables) -> DataFrame:
    c = F.col
    return t.lineitem.select(c("l_orderkey").alias("parent_job_id"), (c("l_linenumber") % 4).alias("child_index"), F.when(c("l_discount") < 0.01, "FAILED").otherwise("SUCCESS").alias("status"), c("l_shipdate").alias("ts"), (c("l_partkey") * 10 + c("l_linenumber")).alias("event_id"), F.lit(4).alias("total_child_count"))


@query("w5_child_groups", f"WITH {CHILDREN} SELECT parent_job_id, child_index, arg_max(status, (status = 'FAILED', ts, event_id)) AS status, arg_max(event_id, (status = 'FAILED', ts, event_id)) AS event_id FROM kids GROUP BY 1, 2")
def w5(t: Tables) -> DataFrame:
    return L.child_groups(children(t))


@query("r4_child_completion", f"WITH {CHILDREN} SELECT parent_job_id, CASE WHEN bool_or(status = 'FAILED') THEN 'failed' WHEN count(DISTINCT child_index) >= 4 THEN 'completed' ELSE 'processing' END AS status FROM kids GROUP BY 1")
def r4(t: Tables) -> DataFrame:
    return L.child_completion(children(t))


@query("r1_fold_job_results", f"WITH {FOLD} SELECT event_id, job_id, status FROM fold")
def r1(t: Tables) -> DataFrame:
    return L.fold_job_results(messages(t)).select("event_id", "job_id", "status")


@query("r1_admission", "SELECT event_id, CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'incomplete' WHEN user_id % 30 NOT IN (SELECT n_nationkey FROM nation) THEN 'unknown instance' END END AS problem FROM events")
def r1_admission(t: Tables) -> DataFrame:
    e = F.col("event_id")
    number = t.events.select("event_id", F.when(e % 11 != 0, F.col("user_id") % 30).alias("instance_id"), F.when(e % 7 != 0, "d").alias("dataset_name"))
    return L.admission(messages(t).join(number, "event_id"), instances(t)).select("event_id", "problem")


@query("r8_duplicate_delivery", f"WITH {FOLD} SELECT event_id, job_id, status FROM fold")
def r8(t: Tables) -> DataFrame:
    return L.fold_job_results(messages(t).union(messages(t).filter("status <> 'PENDING'"))).select("event_id", "job_id", "status")


@query("r9_late_results", f"WITH {FOLD} SELECT count(*) AS late FROM m1 WHERE status IN ('SUCCESS', 'FAILED', 'DELETED') AND event_id NOT IN (SELECT event_id FROM fold)")
def r9(t: Tables) -> DataFrame:
    ends = messages(t).filter(F.col("status").isin(*L.TERMINAL))
    return ends.join(L.fold_job_results(messages(t)).select("event_id"), "event_id", "left_anti").agg(F.count("*").alias("late"))


@query(
    "r1_job_states",
    f"""WITH {FOLD}, moves AS (SELECT job_id, arg_max(status, (ts, event_id)) AS last FROM (SELECT job_id, status, ts, event_id FROM fold UNION ALL SELECT job_id, status, ts, event_id FROM m1 WHERE begun = 1 AND status = 'PROCESSING') GROUP BY 1)
SELECT job_id, CASE last WHEN 'SUCCESS' THEN 'completed' WHEN 'FAILED' THEN 'failed' WHEN 'DELETED' THEN 'deleted' WHEN 'PROCESSING' THEN 'processing' ELSE 'pending' END AS status FROM (SELECT DISTINCT job_id FROM m1 WHERE begun = 1) LEFT JOIN moves USING (job_id)""",
)
def r1_states(t: Tables) -> DataFrame:
    return L.job_states(messages(t))


@query("r2_resource_status", f"WITH {FOLD}, term AS (SELECT resource_id, arg_max(status, (ts, event_id)) AS last FROM fold GROUP BY 1) SELECT resource_id, CASE last WHEN 'FAILED' THEN 'failed' WHEN 'SUCCESS' THEN 'outdated' ELSE 'pending' END AS status FROM (SELECT DISTINCT resource_id FROM messages) LEFT JOIN term USING (resource_id)")
def r2(t: Tables) -> DataFrame:
    ids = messages(t).select("resource_id").distinct()
    last = L.terminal_state(messages(t)).select("resource_id", "last_terminal_status")
    return ids.join(last, "resource_id", "left").select("resource_id", L.resource_status(F.col("last_terminal_status"), F.lit("pending")).alias("status"))


@query("m5_put_latest", f"WITH {JOBS}, {LATEST}, old AS (SELECT * FROM latest WHERE resource_id % 2 = 0) SELECT resource_id, id FROM latest WHERE resource_id % 3 = 0 UNION ALL SELECT resource_id, -id FROM old WHERE resource_id % 3 <> 0")
def m5(t: Tables) -> DataFrame:
    rows = L.latest_resource(jobs(t)).select("resource_id", "id")
    old = rows.filter("resource_id % 2 = 0").withColumn("id", -F.col("id"))
    return L.upsert(old, rows.filter("resource_id % 3 = 0"), ["resource_id"])


@query("m6_put_terminal", f"WITH {FOLD}, term AS (SELECT resource_id, arg_max(job_id, (ts, event_id)) AS job FROM fold GROUP BY 1) SELECT resource_id, job FROM term")
def m6(t: Tables) -> DataFrame:
    now = L.terminal_state(messages(t)).select("resource_id", F.col("last_terminal_job").alias("job"))
    return L.upsert(now.filter("resource_id % 2 = 0").withColumn("job", F.lit("old")), now, ["resource_id"])


@query("m7_labels", f"WITH {LABELS} SELECT resource_id, label FROM labels WHERE label <> 'empty' AND NOT (label LIKE 'mode:%' AND resource_id % 2 = 0) UNION ALL SELECT DISTINCT resource_id, 'seen' FROM labels")
def m7(t: Tables) -> DataFrame:
    have = labels(t)
    seen = have.select("resource_id", F.lit("seen").alias("label"))
    have = L.insert_ignore(have, seen.union(seen), ["resource_id", "label"])
    have = L.remove_labels(have, have.filter("label = 'empty'"))
    return L.remove_label_prefix(have, have.filter("resource_id % 2 = 0"), "mode:")


@query("m8_hints", "SELECT p_partkey AS resource_id, CASE WHEN p_size > 25 THEN ';' WHEN p_size > 10 THEN ',' END AS delimiter FROM part")
def m8(t: Tables) -> DataFrame:
    hints = L.upsert(t.part.filter("p_size > 10").select(F.col("p_partkey").alias("resource_id"), F.lit(",").alias("delimiter")), t.part.filter("p_size > 25").select(F.col("p_partkey").alias("resource_id"), F.lit(";").alias("delimiter")), ["resource_id"])
    return t.part.select(F.col("p_partkey").alias("resource_id")).join(hints, "resource_id", "left")


@query(
    "m12_apply_sync_results",
    """SELECT o_orderkey AS id, o_custkey AS instance_id, CASE WHEN o_orderkey % 3 = 0 AND o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'completed' ELSE 'failed' END WHEN o_orderstatus = 'O' THEN 'running' ELSE 'completed' END AS status,
CASE WHEN o_orderkey % 6 = 0 AND o_orderstatus = 'O' THEN 7 ELSE 0 END AS count, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 AND o_orderstatus = 'O' THEN repeat('e', 16000) END AS error FROM orders""",
)
def m12(t: Tables) -> DataFrame:
    syncs = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("instance_id"), F.when(F.col("o_orderstatus") == "O", "running").otherwise("completed").alias("status"), F.lit(0).alias("count"))
    results = t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("sync_id"), (F.col("o_orderkey") % 2 == 0).alias("success"), F.repeat(F.lit("e"), F.lit(20000)).alias("error"), F.lit(7).alias("count"))
    return L.apply_sync_results(syncs, results)


@query("m13_instances", f"WITH {INSTANCES} SELECT id, name FROM instances WHERE id <> 3 UNION ALL SELECT 99, 'new'")
def m13(t: Tables) -> DataFrame:
    have = instances(t).select("id", "name")
    added = L.insert_ignore(have, t.spark.createDataFrame([(99, "new")], "id int, name string").union(have.filter("id = 5").select(F.lit(98), "name")), ["name"])
    return added.filter("id <> 3")


@query("m14_retry_jobs", f"WITH {JOBS} SELECT id, CASE WHEN resource_id % 2 = 0 THEN ';' END AS delimiter FROM jobs WHERE parent_job_id IS NULL AND status = 'failed'")
def m14(t: Tables) -> DataFrame:
    hints = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("resource_id"), F.lit(";").alias("delimiter"))
    ids = jobs(t).select("resource_id").distinct().filter("resource_id % 2 = 0").select("resource_id", F.lit(";").alias("delimiter"))
    return L.retry_jobs(jobs(t), L.upsert(hints, ids, ["resource_id"])).select("id", "delimiter")


@query("m15_request_syncs", f"""WITH {INSTANCES} SELECT id AS instance_id, concat('{{"id":', id, ',"name":"', name, '","source_type":"portal"}}') AS payload FROM instances WHERE source_type <> 'archive'""")
def m15(t: Tables) -> DataFrame:
    return L.request_syncs(instances(t), include_archive=False)


@query("m17_skip_existing", "SELECT o_orderkey AS resource_id, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = o_orderstatus) AS skipped FROM orders")
def m17(t: Tables) -> DataFrame:
    wanted = t.orders.select(F.col("o_orderkey").alias("resource_id"), F.col("o_orderstatus").alias("version"))
    run, skip = L.skip_existing(wanted, t.lineitem.select(F.col("l_orderkey").alias("resource_id"), F.col("l_linestatus").alias("version")))
    return run.select("resource_id", F.lit(False).alias("skipped")).union(skip.select("resource_id", F.lit(True)))


@query("j10_job_detail", f"WITH {JOBS} SELECT id, status, (SELECT count(*) FROM lineitem WHERE l_orderkey = id) AS n_results, (SELECT count(*) FROM jobs c WHERE c.parent_job_id = j.id) AS n_children FROM jobs j WHERE parent_job_id IS NULL")
def j10(t: Tables) -> DataFrame:
    results = t.lineitem.select(F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("result_id"), F.col("l_returnflag").alias("message"))
    return L.job_detail(jobs(t), results).select("id", "status", F.size("results").cast("long").alias("n_results"), F.coalesce(F.size("children"), F.lit(0)).cast("long").alias("n_children"))


@query(
    "j11_resource_detail",
    f"""WITH {JOBS}, {LABELS}, {LATEST} SELECT resource_id, status, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY created_at DESC, id DESC) FROM (SELECT * FROM jobs b WHERE b.resource_id = latest.resource_id ORDER BY created_at DESC, id DESC LIMIT 5)) AS jobs,
(SELECT string_agg(label, ',' ORDER BY label) FROM labels WHERE labels.resource_id = latest.resource_id) AS labels, (SELECT arg_min(id, (created_at, id)) FROM jobs c WHERE c.resource_id = latest.resource_id AND status = 'completed') AS first_success FROM latest""",
)
def j11(t: Tables) -> DataFrame:
    out = L.resource_detail(L.latest_resource(jobs(t)), jobs(t), labels(t), 5)
    return out.select("resource_id", "status", F.array_join("jobs", ",").alias("jobs"), F.array_join("labels", ",").alias("labels"), "first_success")


@query(
    "r5_result_labels",
    """WITH r AS (SELECT l_orderkey AS resource_id, CAST(l_quantity AS INTEGER) % 4 AS rows, l_linenumber AS columns, l_suppkey % 3 AS expected_rows, CAST(l_extendedprice * 20000 AS BIGINT) AS size, CASE WHEN l_returnflag = 'A' THEN 'Latin1' ELSE 'utf-8' END AS encoding, l_linestatus = 'O' AS success FROM lineitem),
x AS (SELECT resource_id, unnest([CASE WHEN success AND rows = 0 THEN 'empty' END, CASE WHEN success AND rows = 1 THEN 'single-row' END, CASE WHEN success AND columns = 1 THEN 'single-column' END, CASE WHEN success AND rows <> expected_rows THEN 'row-count-mismatch' END,
  CASE WHEN success THEN concat('size:', CASE WHEN size < 1048576 THEN 'small' WHEN size < 1073741824 THEN 'medium' ELSE 'large' END) END, CASE WHEN success AND encoding <> 'utf-8' THEN 'encoding:latin1' END, CASE WHEN success THEN 'reader:csv' END, CASE WHEN NOT success THEN 'http-code:404' END]) AS label FROM r)
SELECT DISTINCT resource_id, label FROM x WHERE label IS NOT NULL""",
)
def r5(t: Tables) -> DataFrame:
    c, none = F.col, F.lit(None)
    results = t.lineitem.select(
        c("l_orderkey").alias("resource_id"), (c("l_quantity").cast("int") % 4).alias("rows"), c("l_linenumber").alias("columns"), (c("l_suppkey") % 3).alias("expected_rows"), none.cast("int").alias("expected_columns"),
        F.round(c("l_extendedprice") * 20000).cast("long").alias("size"), F.when(c("l_returnflag") == "A", "Latin1").otherwise("utf-8").alias("encoding"), F.lit(False).alias("strict"), none.cast("string").alias("delimiter"),
        F.lit("csv").alias("reader"), (c("l_linestatus") == "O").alias("success"), F.lit(404).alias("http_code"),
    )
    return L.result_labels(results)


@query("r7_fan_out", "SELECT l_orderkey AS parent_job_id, l_linenumber AS file_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS child_index, count(*) OVER (PARTITION BY l_orderkey) AS total_child_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) QUALIFY total_child_count > 1")
def r7(t: Tables) -> DataFrame:
    return L.fan_out(t.lineitem.select(F.col("l_orderkey").alias("parent_job_id"), F.col("l_linenumber").alias("file_id")).distinct())[1]


@query(
    "r3_latest_row_guard",
    f"WITH {FOLD}, newest AS (SELECT resource_id, max(job_id) AS latest_job_id FROM messages GROUP BY 1), last AS (SELECT job_id, arg_max(status, (ts, event_id)) AS status, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM fold GROUP BY 1) SELECT resource_id, latest_job_id, coalesce(last.status, 'pending') AS status, ts AS updated_at, CASE WHEN last.job_id IS NULL THEN 'old' ELSE concat('n', event_id) END AS resource_name, CASE WHEN last.job_id IS NULL THEN 'csv' ELSE NULL END AS resource_format FROM newest LEFT JOIN last ON latest_job_id = job_id",
)
def r3(t: Tables) -> DataFrame:
    newest = messages(t).groupBy("resource_id").agg(F.max("job_id").alias("latest_job_id")).withColumns({"status": F.lit("pending"), "updated_at": F.lit(None).cast("timestamp"), "resource_name": F.lit("old"), "resource_format": F.lit("csv")})
    changes = L.fold_job_results(messages(t)).withColumns({"resource_name": F.concat(F.lit("n"), "event_id"), "resource_format": F.lit(None).cast("string")})
    return L.guarded_latest(newest, changes)


@query(
    "a13_outcome_summary",
    """WITH r AS (SELECT o_orderkey AS resource_id, CASE WHEN o_orderkey % 2 = 0 THEN 'csv' ELSE 'datastore' END AS reader, count(l_linenumber) AS n, o_orderkey % 7 AS m FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT resource_id, reader, CASE m WHEN 0 THEN 'DELETED' WHEN 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN m > 1 THEN n ELSE 0 END AS rows_processed, CASE WHEN m > 1 THEN 11 END::BIGINT AS columns, CASE WHEN m <> 3 THEN 4 END::BIGINT AS expected_rows, 11::BIGINT AS expected_columns,
CASE WHEN m > 1 AND m <> 3 THEN n = 4 END AS rows_agree, CASE WHEN m > 1 THEN true END AS columns_agree, CASE m WHEN 0 THEN '404' WHEN 1 THEN 'parser' END AS error_message FROM r""",
)
def a13(t: Tables) -> DataFrame:
    """Orders as readings of their lines, some of them failed or gone."""
    m = F.col("o_orderkey") % 7
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    rows = t.orders.join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("resource_id"),
        F.when(F.col("o_orderkey") % 2 == 0, "csv").otherwise("datastore").alias("reader"),
        F.coalesce("n", F.lit(0)).alias("rows"),
        F.lit(len(t.lineitem.columns)).alias("columns"),
        F.when(m != 3, 4).alias("expected_rows"),
        F.lit(11).alias("expected_columns"),
        F.when(m == 0, "404").when(m == 1, "parser").alias("error"),
        (m == 0).alias("deleted"),
    )
    return L.outcome_summary(rows)


@query("j1_list_with_instances", f"WITH {JOBS} SELECT j.id, j.instance_id, i.name AS instance_name FROM jobs j LEFT JOIN (SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey % 5 > 0) i ON j.instance_id = i.id WHERE j.parent_job_id IS NULL")
def j1(t: Tables) -> DataFrame:
    """Top-level jobs with their instances, of which some are not there."""
    instances = t.nation.filter("n_nationkey % 5 > 0").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return L.list_jobs(jobs(t), instances).select("id", "instance_id", "instance_name")
