"""Jobs, results, labels and instances: current state, lists and dashboards as set-based plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATUSES = ("pending", "processing", "completed", "failed", "deleted", "outdated")
TERMINAL = {"SUCCESS": "completed", "FAILED": "failed", "DELETED": "deleted"}
MB = 1 << 20


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with its rows replaced by those of ``rows`` with the same keys, and the others added."""
    return table.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(table.columns).unionByName(rows)


def insert_ignore(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with the rows whose keys it lacks, one a key."""
    new = rows.dropDuplicates(list(keys)).join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(new.select(table.columns))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, by one aggregation without a sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("newest__row")).select(*keys, "newest__row.*")


# lists

def list_jobs(jobs: DataFrame, instances: DataFrame, status: str | None = None, resource: int | None = None, instance: int | None = None) -> DataFrame:
    """Top-level jobs with the names of their instances."""
    out = jobs.filter("parent_job_id IS NULL")
    for column, value in (("status", status), ("resource_id", resource), ("instance_id", instance)):
        if value is not None:
            out = out.filter(F.col(column) == F.lit(value))
    return out.join(instances.select(F.col("id").alias("instance_id"), F.col("name").alias("instance_name")), "instance_id", "left")


def with_labels(rows: DataFrame, labels: DataFrame, tags: Sequence[str], key: str = "resource_id") -> DataFrame:
    """Rows that have any of the labels; all rows if no label is asked for."""
    return rows.join(labels.filter(F.col("label").isin(*tags)).select(key).distinct(), key, "left_semi") if tags else rows


def labels_by_resource(labels: DataFrame) -> DataFrame:
    return labels.groupBy("resource_id").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def job_counts(resources: DataFrame, jobs: DataFrame) -> DataFrame:
    counts = jobs.groupBy("resource_id").agg(F.count("*").alias("n_jobs"))
    return resources.join(counts, "resource_id", "left").withColumn("n_jobs", F.coalesce("n_jobs", F.lit(0)))


def dataset_rollup(latest_rows: DataFrame, labels: DataFrame, search: str | None = None) -> DataFrame:
    """By instance and dataset: resources in all, by status and labelled empty, and the newest change."""
    rows = latest_rows if search is None else latest_rows.filter(F.col("dataset_name").like(f"%{search}%"))
    empty = labels.filter("label = 'empty'").select("resource_id").distinct().withColumn("is_empty", F.lit(1))
    by_status = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return rows.join(empty, "resource_id", "left").groupBy("instance_id", "dataset_name").agg(F.count("*").alias("total"), *by_status, F.count("is_empty").alias("empty"), F.max("created_at").alias("updated_at"))


def dashboard(instances: DataFrame, latest_rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of each instance; zeros for one without rows."""
    empty = labels.filter("label = 'empty'").select("resource_id").distinct().withColumn("is_empty", F.lit(1))
    counts = latest_rows.join(empty, "resource_id", "left").groupBy("instance_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.count("is_empty").alias("empty"))
    names = ["total", *STATUSES, "empty"]
    return instances.join(counts, instances["id"] == counts["instance_id"], "left").select("id", "name", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def instance_counts(latest_rows: DataFrame) -> DataFrame:
    return latest_rows.groupBy("instance_id").agg(F.countDistinct("dataset_name").alias("datasets"), F.count("*").alias("resources"))


def list_syncs(syncs: DataFrame, instances: DataFrame, instance: int | None = None) -> DataFrame:
    rows = syncs if instance is None else syncs.filter(F.col("instance_id") == instance)
    return rows.join(instances.select(F.col("id").alias("instance_id"), F.col("name").alias("instance_name")), "instance_id", "left").orderBy(F.desc("start_time"), "id")


def job_detail(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Parent jobs with their results and their children with theirs, as nested lists in id order."""
    by_job = results.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("result_id", "message"))).alias("results"))
    full = jobs.join(by_job, jobs["id"] == by_job["job_id"], "left").select("id", "parent_job_id", "status", F.coalesce("results", F.array().cast("array<struct<result_id:int,message:string>>")).alias("results"))
    children = full.filter("parent_job_id IS NOT NULL").groupBy(F.col("parent_job_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("id", "status", "results"))).alias("children"))
    return full.filter("parent_job_id IS NULL").drop("parent_job_id").join(children, "id", "left")


def resource_detail(latest_rows: DataFrame, jobs: DataFrame, labels: DataFrame, most: int = 500) -> DataFrame:
    """Latest row of each resource with its newest jobs (at most ``most``, newest first), labels and first successful job."""
    newest = Window.partitionBy("resource_id").orderBy(F.desc("created_at"), F.desc("id"))
    ranked = jobs.withColumn("k", F.row_number().over(newest)).filter(F.col("k") <= most)
    lists = ranked.groupBy("resource_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "id"))), lambda x: x["id"]).alias("jobs"))
    first = jobs.filter("status = 'completed'").groupBy("resource_id").agg(F.min_by("id", F.struct("created_at", "id")).alias("first_success"))
    return latest_rows.select("resource_id", "status").join(lists, "resource_id", "left").join(labels_by_resource(labels), "resource_id", "left").join(first, "resource_id", "left")


# state

def latest_resource(jobs: DataFrame) -> DataFrame:
    """The latest job of each resource: newest creation, then the last to arrive."""
    return latest(jobs.filter("parent_job_id IS NULL"), ["resource_id"], ["created_at", "id"])


def pending_versions(resources: DataFrame, jobs: DataFrame) -> DataFrame:
    """Resources with a URL and a version for which no job is completed."""
    done = jobs.filter("status = 'completed'").select("resource_id", "version").distinct()
    wanted = resources.filter((F.coalesce("url", F.lit("")) != "") & (F.coalesce("version", F.lit("")) != ""))
    return wanted.join(done, ["resource_id", "version"], "left_anti")


def skip_existing(jobs: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jobs to run, jobs whose resource version is converted already)."""
    keys = ["resource_id", "version"]
    have = registry.select(*keys).distinct()
    return jobs.join(have, keys, "left_anti"), jobs.join(have, keys, "left_semi")


def retry_jobs(jobs: DataFrame, hints: DataFrame) -> DataFrame:
    """Parent jobs that failed, with the delimiter hint of their resource."""
    return jobs.filter("parent_job_id IS NULL AND status = 'failed'").join(hints, "resource_id", "left")


def request_syncs(instances: DataFrame, include_archive: bool = True) -> DataFrame:
    rows = instances if include_archive else instances.filter("source_type <> 'archive'")
    return rows.select(F.col("id").alias("instance_id"), F.to_json(F.struct("id", "name", "source_type")).alias("payload"))


def remove_labels(labels: DataFrame, gone: DataFrame) -> DataFrame:
    return labels.join(gone.select("resource_id", "label"), ["resource_id", "label"], "left_anti")


def remove_label_prefix(labels: DataFrame, resources: DataFrame, prefix: str) -> DataFrame:
    """Without the labels with the prefix of the given resources."""
    return remove_labels(labels, labels.filter(F.col("label").startswith(prefix)).join(resources.select("resource_id").distinct(), "resource_id", "left_semi"))


def apply_sync_results(syncs: DataFrame, results: DataFrame, most: int = 16000) -> DataFrame:
    """Syncs after their results: only running ones change; a failure keeps the counts and its error is cut.

    The first result of a sync ends it: the earliest by ``ts``, if the results
    have one; of equal ones a failure, then the smaller error and count.  Errors
    can be long and alike, so that little on disk is much in memory: failures
    are cut first, successes lose theirs once they are in order, and the join
    sorts instead of holding them in a hash table.
    """
    time = [F.col("ts")] if "ts" in results.columns else []
    error = F.when(F.col("success"), F.col("error")).otherwise(F.left("error", F.lit(most)))
    first = F.min(F.struct(*time, F.col("success").alias("r_success"), error.alias("r_error"), F.col("count").alias("r_count"))).alias("first")
    own = results.filter("success IS NOT NULL").groupBy(F.col("sync_id").alias("id")).agg(first)
    own = own.select("id", "first.r_success", F.when(~F.col("first.r_success"), F.col("first.r_error")).alias("r_error"), "first.r_count")
    joined = syncs.join(own.hint("merge"), "id", "left")
    hit = (F.col("status") == "running") & F.col("r_success").isNotNull()
    return joined.select(
        "id",
        "instance_id",
        F.when(hit & F.col("r_success"), "completed").when(hit, "failed").otherwise(F.col("status")).alias("status"),
        F.when(hit & F.col("r_success"), F.col("r_count")).otherwise(F.col("count")).alias("count"),
        F.when(hit, F.col("r_error")).alias("error"),
    )


# messages

def validate_results(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, ignored, rejected) messages: a status must be known and ids must be there; a success without a job is ignored."""
    known = F.coalesce(F.col("status").isin("PENDING", "PROCESSING", *TERMINAL), F.lit(False))
    ids = (F.coalesce(F.col("job_id"), F.lit("")) != "") & F.col("resource_id").isNotNull()
    idle = F.coalesce((F.col("status") == "SUCCESS") & (F.coalesce(F.col("job_id"), F.lit("")) == ""), F.lit(False))
    return messages.filter(known & ids), messages.filter(idle), messages.filter(~(known & ids) & ~idle)


def admission(messages: DataFrame, instances: DataFrame) -> DataFrame:
    """Messages with ``problem``: null for those that may be folded.

    A PENDING message begins a job only with a dataset_name and an instance_id
    ("incomplete" otherwise) of instances (id) that exist ("unknown instance").
    Any other message needs no more than its job, which the fold sees to.
    """
    known = instances.select(F.col("id").alias("admitting_id")).filter("admitting_id IS NOT NULL").distinct()
    whole = F.col("dataset_name").isNotNull() & F.col("instance_id").isNotNull()
    problem = F.when(F.col("status") == "PENDING", F.when(~whole, "incomplete").when(F.col("admitting_id").isNull(), "unknown instance"))
    return messages.join(known, F.col("instance_id") == F.col("admitting_id"), "left").withColumn("problem", problem).drop("admitting_id")


def fold_job_results(messages: DataFrame) -> DataFrame:
    """Effective terminal results of messages (event_id, ts, resource_id, job_id, status), in time order by job.

    A job begins with its first PENDING; what comes before is dropped.  The
    first SUCCESS, FAILED or DELETED counts, and after each PROCESSING the first
    again.  Repeated messages (the same event_id) count once.
    """
    by_job = Window.partitionBy("job_id").orderBy("ts", "event_id")
    rows = messages.dropDuplicates(["event_id"]).withColumn("begun", F.max(F.when(F.col("status") == "PENDING", 1)).over(by_job)).filter("begun = 1")
    rows = rows.withColumn("epoch", F.count(F.when(F.col("status") == "PROCESSING", 1)).over(by_job))
    ends = rows.filter(F.col("status").isin(*TERMINAL))
    return ends.withColumn("k", F.row_number().over(Window.partitionBy("job_id", "epoch").orderBy("ts", "event_id"))).filter("k = 1").drop("k", "begun")


def job_states(messages: DataFrame) -> DataFrame:
    """(job_id, status) of every job that began."""
    effective = fold_job_results(messages).select("event_id", F.lit(True).alias("effective"))
    started = messages.groupBy("job_id").agg(F.min(F.when(F.col("status") == "PENDING", F.struct("ts", "event_id"))).alias("began")).filter("began IS NOT NULL")
    rows = messages.dropDuplicates(["event_id"]).join(effective, "event_id", "left").join(started, "job_id").filter(F.struct("ts", "event_id") >= F.col("began"))
    moves = rows.filter("effective OR status = 'PROCESSING'").groupBy("job_id").agg(F.max_by("status", F.struct("ts", "event_id")).alias("last"))
    status = F.lit("pending")
    for message, name in {**TERMINAL, "PROCESSING": "processing"}.items():
        status = F.when(F.col("last") == message, name).otherwise(status)
    return started.select("job_id").join(moves, "job_id", "left").select("job_id", status.alias("status"))


def terminal_state(messages: DataFrame) -> DataFrame:
    """Of each resource: last terminal job, status and time, and the last successful job, which later failures leave."""
    order = F.struct("ts", "event_id")
    good = F.when(F.col("status") == "SUCCESS", F.col("job_id"))
    return fold_job_results(messages).groupBy("resource_id").agg(
        F.max_by("job_id", order).alias("last_terminal_job"),
        F.max_by("status", order).alias("last_terminal_status"),
        F.max("ts").alias("last_terminal_at"),
        F.max_by(good, F.when(good.isNotNull(), order)).alias("last_successful_job"),
    )


def resource_status(last_terminal: Column, status: Column) -> Column:
    """Status of a resource with a new pending job, by how its last one ended."""
    return F.when(status != "pending", status).when(last_terminal == "FAILED", "failed").when(last_terminal == "SUCCESS", "outdated").otherwise("pending")


#: What a latest row takes over from its job.
COPIED = ("resource_name", "resource_url", "resource_format", "dataset_name")


def guarded_latest(latest_rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Latest rows (resource_id, latest_job_id, status, updated_at) after status changes (resource_id, job_id, status, ts, event_id).

    Only the job that is its resource's latest may change the row; changes by
    older jobs, and of resources without a row, do nothing.  Of several changes
    the last counts.  It also brings the job's name, URL, format and dataset
    name of the resource, of these columns those that both tables have.
    """
    copied = [c for c in COPIED if c in latest_rows.columns and c in changes.columns]
    last = changes.groupBy("resource_id", "job_id").agg(F.max_by(F.struct("status", "ts", *copied), F.struct("ts", "event_id")).alias("change"))
    mine = latest_rows.join(last.select("resource_id", F.col("job_id").alias("latest_job_id"), "change"), ["resource_id", "latest_job_id"], "left")
    changed = {c: F.when(F.col("change").isNotNull(), F.col(f"change.{c}")).otherwise(F.col(c)) for c in copied}
    return mine.withColumns({"status": F.coalesce("change.status", "status"), "updated_at": F.coalesce("change.ts", "updated_at"), **changed}).drop("change")


def outcome_summary(results: DataFrame) -> DataFrame:
    """What is reported of each reading (resource_id, reader, rows, columns, expected_rows, expected_columns, error, deleted).

    A success reports its rows and columns; a failure none, and its error; a
    gone resource is DELETED.  Whether rows and columns are as expected is null
    where nothing was expected or nothing was read.
    """
    good = F.col("error").isNull() & ~F.coalesce("deleted", F.lit(False))
    agrees = lambda c: F.when(good, F.col(c) == F.col(f"expected_{c}"))
    return results.select(
        "resource_id",
        "reader",
        F.when(good, "SUCCESS").when(F.coalesce("deleted", F.lit(False)), "DELETED").otherwise("FAILED").alias("status"),
        F.when(good, F.col("rows")).otherwise(0).cast("long").alias("rows_processed"),
        F.when(good, F.col("columns")).cast("long").alias("columns"),
        F.col("expected_rows").cast("long").alias("expected_rows"),
        F.col("expected_columns").cast("long").alias("expected_columns"),
        agrees("rows").alias("rows_agree"),
        agrees("columns").alias("columns_agree"),
        F.when(~good, F.col("error")).alias("error_message"),
    )


def child_groups(results: DataFrame) -> DataFrame:
    """The standing result of each child (parent, index): a failure sticks, else the last one."""
    order = F.struct((F.col("status") == "FAILED").alias("failed"), "ts", "event_id")
    return results.groupBy("parent_job_id", "child_index").agg(F.max_by("status", order).alias("status"), F.max_by("event_id", order).alias("event_id"))


def child_completion(results: DataFrame) -> DataFrame:
    """(parent_job_id, status): failed with the first failed child, completed when all indexes are there, else processing."""
    groups = child_groups(results)
    totals = results.groupBy("parent_job_id").agg(F.max("total_child_count").alias("expected"))
    counts = groups.groupBy("parent_job_id").agg(F.count_if(F.col("status") == "FAILED").alias("failed"), F.count_if(F.col("status") == "SUCCESS").alias("done"))
    status = F.when(F.col("failed") > 0, "failed").when(F.col("done") >= F.col("expected"), "completed").otherwise("processing")
    return counts.join(totals, "parent_job_id").select("parent_job_id", status.alias("status"))


def result_labels(results: DataFrame) -> DataFrame:
    """(resource_id, label) of job results.

    Columns: rows, columns, expected_rows, expected_columns, size, encoding,
    strict, delimiter, reader, success, http_code; a null gives no label.
    """
    c, good = F.col, F.coalesce(F.col("success"), F.lit(False))
    size = F.when(c("size") < MB, "small").when(c("size") < 1024 * MB, "medium").when(c("size").isNotNull(), "large")
    labels = F.array(
        F.when(good & (c("rows") == 0), "empty"),
        F.when(good & (c("rows") == 1), "single-row"),
        F.when(good & (c("columns") == 1), "single-column"),
        F.when(good & (c("rows") != c("expected_rows")), "row-count-mismatch"),
        F.when(good & (c("columns") != c("expected_columns")), "column-count-mismatch"),
        F.when(good, F.concat(F.lit("size:"), size)),
        F.when(good & (F.lower("encoding") != "utf-8"), F.concat(F.lit("encoding:"), F.lower("encoding"))),
        F.when(good & c("strict"), "strict"),
        F.when(good, F.concat(F.lit("delimiter:"), c("delimiter"))),
        F.when(good, F.concat(F.lit("reader:"), c("reader"))),
        F.when(~good, F.concat(F.lit("http-code:"), c("http_code"))),
    )
    return results.select("resource_id", F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("label")).distinct()


def fan_out(children: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of parents' discovered files (parent_job_id, file_id): (manifest, child jobs).

    Parents with one file have no manifest and no children; they are read
    inline.  Children are numbered from 0 in the order of their ids.
    """
    manifest = children.groupBy("parent_job_id").agg(F.count("*").alias("total_child_count")).filter("total_child_count > 1")
    numbered = children.withColumn("child_index", F.row_number().over(Window.partitionBy("parent_job_id").orderBy("file_id")) - 1)
    return manifest, numbered.join(manifest, "parent_job_id").select("parent_job_id", "file_id", "child_index", "total_child_count")
