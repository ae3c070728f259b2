"""The source catalogue: snapshots, trees, links of tables to resources, search, artifacts and publications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import fold_accents, older_than, stable_id
from ..plans.folders import shared_folder, stored

#: Levels of a resource tree that are followed; a deeper or cyclic one is an error.
DEPTH = 32


# snapshots

def diff_snapshots(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(source_id, id, change) with new, deleted, changed or unchanged for every row of either snapshot."""
    p = previous.select("source_id", "id", F.col("version").alias("old"), F.lit(True).alias("was"))
    c = current.select("source_id", "id", F.col("version").alias("new"), F.lit(True).alias("is"))
    change = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "deleted").when(~F.col("old").eqNullSafe(F.col("new")), "changed").otherwise("unchanged")
    return p.join(c, ["source_id", "id"], "full").select("source_id", "id", change.alias("change"))


def observe(state: DataFrame, batch: DataFrame, sync_id: str) -> DataFrame:
    """State (source_id, id, version, title, first_seen, last_changed, last_seen, deleted_at) after a batch (source_id, id, version, title).

    A row changes when its version differs, byte for byte and null-safe, or it
    was deleted; its fields and last_seen are renewed either way.
    """
    old = state.select("source_id", "id", *[F.col(c).alias(f"old_{c}") for c in ("version", "title", "first_seen", "last_changed", "last_seen", "deleted_at")], F.lit(True).alias("was"))
    joined = old.join(batch.withColumn("is", F.lit(True)), ["source_id", "id"], "full")
    seen, now = F.col("is").isNotNull(), F.lit(sync_id)
    changed = seen & (F.col("was").isNull() | F.col("old_deleted_at").isNotNull() | ~F.col("version").eqNullSafe(F.col("old_version")))
    pick = lambda c: F.when(seen, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
    return joined.select(
        "source_id",
        "id",
        pick("version"),
        pick("title"),
        F.coalesce("old_first_seen", now).alias("first_seen"),
        F.when(changed, now).otherwise(F.col("old_last_changed")).alias("last_changed"),
        F.when(seen, now).otherwise(F.col("old_last_seen")).alias("last_seen"),
        F.when(~seen, F.col("old_deleted_at")).alias("deleted_at"),
    )


def tombstones(state: DataFrame, sync_id: str, source_id: str) -> DataFrame:
    """Rows of the source that the sync has not seen, now deleted unless they were."""
    gone = (F.col("source_id") == source_id) & (F.col("last_seen") != sync_id) & F.col("deleted_at").isNull()
    return state.withColumn("deleted_at", F.when(gone, F.lit(sync_id)).otherwise(F.col("deleted_at")))


def sync_counts(state: DataFrame, sync_id: str, kind: str = "kind") -> DataFrame:
    """Counts of a sync: root collections are datasets, all else but collections is a resource."""
    c = F.col
    resource = c(kind) != "collection"
    return state.agg(
        F.count_if((c(kind) == "collection") & c("parent_id").isNull() & c("deleted_at").isNull()).alias("datasets"),
        F.count_if(resource & c("deleted_at").isNull()).alias("resources"),
        F.count_if(resource & (c("first_seen") == sync_id)).alias("new"),
        F.count_if(resource & (c("last_changed") == sync_id) & (c("first_seen") != sync_id)).alias("updated"),
        F.count_if(resource & (c("deleted_at") == sync_id)).alias("deleted"),
    )


def plan_messages(source: str, sync_id: str, planned: DataFrame, deleted: DataFrame) -> DataFrame:
    """Announcements (message_id, key, kind, payload): PENDING for each planned resource, DELETED for each tombstone, one sync result."""
    def of(rows: DataFrame, kind: str) -> DataFrame:
        name = F.concat_ws(":", F.lit(source), F.lit(sync_id), F.lit(kind), F.col("id").cast("string"))
        payload = F.to_json(F.struct(F.lit(kind).alias("status"), F.col("id").cast("string").alias("resource_id"), F.lit(sync_id).alias("sync_id")))
        return rows.select(stable_id(name).alias("message_id"), F.col("id").cast("string").alias("key"), F.lit(kind).alias("kind"), payload.alias("payload"))

    total = planned.agg(F.count("*").alias("planned"))
    result = total.select(stable_id(F.lit(f"{source}:{sync_id}:RESULT")).alias("message_id"), F.lit(source).alias("key"), F.lit("RESULT").alias("kind"), F.to_json(F.struct("planned")).alias("payload"))
    return of(planned, "PENDING").union(of(deleted, "DELETED")).union(result)


def complete_sync(state: DataFrame, jobs: DataFrame, source: str, sync_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state with tombstones, counts, messages); a replay gives the same messages with the same ids."""
    after = tombstones(state, sync_id, source)
    live = after.filter(F.col("deleted_at").isNull() & F.col("version").isNotNull())
    planned = live.join(jobs.filter("status = 'completed'").select(F.col("resource_id").alias("id"), "version").distinct(), ["id", "version"], "left_anti")
    counts = sync_counts(after, sync_id).crossJoin(planned.agg(F.count("*").alias("planned")))  # one row each
    return after, counts, plan_messages(source, sync_id, planned.select("id"), after.filter(F.col("deleted_at") == sync_id).select("id"))


def select_snapshots(headers: DataFrame, imports: DataFrame) -> DataFrame:
    """Headers with a decision: imported before, superseded by a newer one of the source, or to import."""
    newest = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("collected_at"), F.desc("sync_id")))
    done = imports.select("source_id", "sync_id", F.lit(True).alias("done"))
    choice = F.when(F.col("done"), "imported").when(F.col("k") > 1, "superseded").otherwise("import")
    return headers.withColumn("k", newest).join(done, ["source_id", "sync_id"], "left").withColumn("decision", choice).drop("k", "done")


def import_snapshot(state: DataFrame, rows: DataFrame, source: str, sync_id: str, default_title: str = "untitled") -> DataFrame:
    """Catalogue state after a snapshot of one source; other sources' rows stay.

    A status stays only if the version is unchanged and the row was live; else
    it is discovered.  A blank title becomes the metadata name, the URL's file
    name or the default.  Absent rows become tombstones.
    """
    from ..functions.scalars import first_text, json_text, url_name

    other, own = state.filter(F.col("source_id") != source), state.filter(F.col("source_id") == source)
    title = F.coalesce(first_text(F.col("title"), json_text(F.col("metadata"), "$.name"), url_name(F.col("url"))), F.lit(default_title))
    new = rows.select("id", F.col("version").alias("new_version"), title.alias("new_title"), F.lit(True).alias("is"))
    joined = own.withColumn("was", F.lit(True)).join(new, "id", "full")
    seen = F.col("is").isNotNull()
    same = F.col("was").isNotNull() & F.col("deleted_at").isNull() & F.col("version").eqNullSafe(F.col("new_version"))
    merged = joined.select(
        F.lit(source).alias("source_id"),
        "id",
        F.when(seen, F.col("new_version")).otherwise(F.col("version")).alias("version"),
        F.when(seen, F.col("new_title")).otherwise(F.col("title")).alias("title"),
        F.when(~seen | same, F.col("status")).otherwise("discovered").alias("status"),
        F.when(~seen, F.coalesce("deleted_at", F.lit(sync_id))).alias("deleted_at"),
    )
    return other.select(merged.columns).unionByName(merged)


def replace_collection(table: DataFrame, source_id: str, rows: DataFrame) -> DataFrame:
    """One source's rows replaced; a row of another source is an error."""
    checked = rows.withColumn("source_id", F.when(F.col("source_id") == source_id, F.col("source_id")).otherwise(F.raise_error(F.lit("row of another source"))))
    return table.filter(F.col("source_id") != source_id).unionByName(checked)


# trees

def resource_paths(resources: DataFrame, default: str = "untitled", depth: int = DEPTH) -> DataFrame:
    """(source_id, id, path) with the titles from the root to each resource (source_id, id, parent_id, title).

    Each step doubles the ancestors that are known, so the number of joins is
    the logarithm of the depth.  A tree deeper than ``depth``, such as a cycle, is an error.
    """
    title = F.coalesce(F.when(F.trim("title") != "", F.col("title")), F.lit(default))
    rows = resources.select("source_id", "id", F.col("parent_id").alias("up"), F.array(title).alias("path"))
    steps = 1
    while steps < depth:
        above = rows.select("source_id", F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        rows = rows.join(above, ["source_id", "up"], "left").select("source_id", "id", F.col("next").alias("up"), F.when(F.col("head").isNotNull(), F.concat("head", "path")).otherwise(F.col("path")).alias("path"))
        steps *= 2
    return rows.select("source_id", "id", F.when(F.col("up").isNull(), F.col("path")).otherwise(F.raise_error(F.lit("the tree has a cycle or is too deep"))).alias("path"))


def validate_tree(resources: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(source_id, id, problem) of rows whose parent is missing, and of rows that no root reaches."""
    keys = resources.select("source_id", F.col("id").alias("parent_id"))
    missing = resources.filter("parent_id IS NOT NULL").join(keys, ["source_id", "parent_id"], "left_anti").select("source_id", "id", F.lit("missing parent").alias("problem"))
    links = resources.select("source_id", "id", "parent_id").join(missing.select("source_id", "id", F.lit(True).alias("lost")), ["source_id", "id"], "left")
    up = links.select("source_id", "id", F.when(F.col("lost").isNull(), F.col("parent_id")).alias("up"))
    steps = 1
    while steps < depth:
        above = up.select("source_id", F.col("id").alias("up"), F.col("up").alias("next"))
        up = up.join(above, ["source_id", "up"], "left").select("source_id", "id", F.col("next").alias("up"))
        steps *= 2
    return missing.union(up.filter("up IS NOT NULL").select("source_id", "id", F.lit("cycle")))


def available_collections(resources: DataFrame, tables: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(source_id, id) of live collections with a live table below; a deleted node stops the way up."""
    folder = shared_folder(resources.sparkSession, "collections")
    live = resources.filter("deleted_at IS NULL").select("source_id", "id", "parent_id", "kind")
    now = live.join(tables.select("source_id", F.col("resource_id").alias("id")).distinct(), ["source_id", "id"], "left_semi")
    found = now
    for level in range(depth):
        now = now.select("source_id", F.col("parent_id").alias("id")).filter("id IS NOT NULL").distinct().join(live, ["source_id", "id"])
        now = stored(now.join(found.select("source_id", "id"), ["source_id", "id"], "left_anti"), f"{folder}/{level}")
        if now.isEmpty():
            break
        found = found.unionByName(now)
    return found.filter("kind = 'collection'").select("source_id", "id")


# tables

def link_tables(tables: DataFrame, tags: DataFrame, resources: DataFrame) -> DataFrame:
    """(table_name, resource_id): a table's tag if it has one, else the resource that it is named by."""
    tagged = tables.join(tags.select("table_name", F.col("resource_id").alias("tagged")), "table_name", "left")
    named = resources.select(F.col("id").alias("named"))
    joined = tagged.join(named, F.col("table_name") == F.col("named").cast("string"), "left")
    return joined.select("table_name", F.coalesce("tagged", "named").alias("resource_id")).filter("resource_id IS NOT NULL")


def _joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A left join whose null keys, which match nothing, aren't all dealt to one task."""
    return left.filter(F.col(key).isNotNull()).join(right, key, "left").unionByName(left.filter(F.col(key).isNull()), allowMissingColumns=True)


def enrich_legacy(tables: DataFrame, resources: DataFrame, datasets: DataFrame) -> DataFrame:
    """Tables with title, description and dataset, falling back from resource to dataset to the table's name."""
    r = resources.select(F.col("id").alias("resource_id"), F.col("title").alias("r_title"), F.col("description").alias("r_description"), "dataset_id")
    d = datasets.select(F.col("id").alias("dataset_id"), F.col("title").alias("d_title"), F.col("description").alias("d_description"))
    joined = _joined(tables, _joined(r, d, "dataset_id"), "resource_id")
    return joined.select("table_name", F.coalesce("r_title", "d_title", "table_name").alias("title"), F.coalesce("r_description", "d_description", F.lit("")).alias("description"), F.col("d_title").alias("dataset"))


def resource_tables(links: DataFrame, resource_id: Column | None = None) -> DataFrame:
    rows = links if resource_id is None else links.filter(F.col("resource_id") == resource_id)
    return rows.groupBy("source_id", "resource_id").agg(F.array_sort(F.collect_set("table_name")).alias("tables"))


def files_for_tables(index: DataFrame, names: Sequence[str], most: int = 50) -> DataFrame:
    """Files of the named tables; an unknown table or more than ``most`` is an error."""
    if len(set(names)) > most:
        raise ValueError(f"at most {most} tables")
    rows = index.filter(F.col("table_name").isin(*names))
    known = {r[0] for r in rows.select("table_name").distinct().collect()}
    if unknown := set(names) - known:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    return rows.distinct()


def files_by_table(registry: DataFrame) -> DataFrame:
    return registry.groupBy("table_name").agg(F.array_sort(F.collect_set(F.when(F.col("kind") == "data", F.col("file")))).alias("data"), F.array_sort(F.collect_set(F.when(F.col("kind") == "delete", F.col("file")))).alias("deletes"))


def search_catalog(tables: DataFrame, term: str, columns: Sequence[str] = ("title", "source", "description", "dataset", "path")) -> DataFrame:
    """Tables that hold the term in any column, without regard to case and accents."""
    found = F.lit(False)
    for c in columns:
        if c in tables.columns:
            found = found | F.coalesce(F.contains(fold_accents(F.col(c)), fold_accents(F.lit(term))), F.lit(False))
    return tables.filter(found)


def split_tags(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def categorize(table_name: Column, linked: Column, metadata: Sequence[str] = ("packages", "resources")) -> Column:
    """metadata for catalogue and declared collections, data for tables with a resource, else legacy."""
    return F.when(table_name.startswith("catalog_") | table_name.isin(*metadata), "metadata").when(linked, "data").otherwise("legacy")


def visible_tables(tables: DataFrame, source: str | None = None, parent: int | None = None, term: str | None = None) -> DataFrame:
    """Data tables that are not deleted, of a source, below a parent, and found by a term, as far as given."""
    rows = tables.filter("category = 'data' AND deleted_at IS NULL")
    if source is not None:
        rows = rows.filter(F.col("source_id") == source)
    if parent is not None:
        rows = rows.filter(F.col("parent_id") == parent)
    return rows if term is None else search_catalog(rows, term)


def select_category(df: DataFrame, year: int, name: str) -> DataFrame:
    rows = df.filter((F.col("year") == year) & (F.lower("category") == name.lower()))
    if rows.isEmpty():
        raise ValueError(f"no members of {name} in {year}")
    return rows


def register_table(registry: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Registry (resource_id, version, job_id, path) after artifacts of the same columns.

    An artifact is skipped if the stored version is the same or later (as text)
    or of the same job; of several artifacts of a resource the latest version wins.
    """
    from .ledger import latest, upsert

    new = latest(artifacts, ["resource_id"], ["version", "job_id"])
    old = registry.select("resource_id", F.col("version").alias("old_version"), F.col("job_id").alias("old_job"))
    fresh = new.join(old, "resource_id", "left").filter((F.col("old_version").isNull() | (F.col("version") > F.col("old_version"))) & ~F.coalesce(F.col("job_id") == F.col("old_job"), F.lit(False)))
    return upsert(registry, fresh.select(registry.columns), ["resource_id"])


def refresh_links(resources: DataFrame, links: DataFrame, registry: DataFrame) -> DataFrame:
    """Resources whose table has their version are completed, if they were only discovered and are live."""
    have = registry.join(links.select("resource_id"), "resource_id", "left_semi").select(F.col("resource_id").alias("id"), F.col("version").alias("table_version"))
    done = (F.col("status") == "discovered") & F.col("deleted_at").isNull() & (F.col("table_version") == F.col("version"))
    return resources.join(have, "id", "left").withColumn("status", F.when(done, "completed").otherwise(F.col("status"))).drop("table_version")


# artifacts and publications

def classify_artifacts(objects: DataFrame, prefix: str = "ducklake") -> DataFrame:
    """(object_key, size, folder, kind) of stored objects: live, orphan or ignored.

    The greatest ``<prefix>_*.parquet`` key of a folder is live and the others
    are orphans, as are ``<prefix>-*.parquet`` keys and all Parquet files below
    main/<uuid>/.
    """
    key = F.col("object_key")
    folder, name = F.regexp_extract(key, "^(.*)/[^/]*$", 1), F.element_at(F.split(key, "/"), -1)
    dated = name.rlike(rf"^{prefix}_.*\.parquet$") & ~key.startswith("main/")
    loose = (name.rlike(rf"^{prefix}-.*\.parquet$") & ~key.startswith("main/")) | key.rlike(r"^main/[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}/.*\.parquet$")
    rows = objects.withColumn("folder", folder).withColumn("dated", dated).withColumn("loose", loose)
    newest = rows.filter("dated").groupBy("folder").agg(F.max("object_key").alias("newest"))
    kind = F.when(F.col("dated") & (key == F.col("newest")), "live").when(F.col("dated") | F.col("loose"), "orphan").otherwise("ignored")
    return rows.join(newest, "folder", "left").select("object_key", "size", "folder", kind.alias("kind"))


def storage_summary(objects: DataFrame) -> DataFrame:
    k = F.col("kind")
    return classify_artifacts(objects).agg(F.count("*").alias("objects"), F.count_if(k == "live").alias("live"), F.count_if(k == "orphan").alias("orphans"), F.sum(F.when(k == "orphan", F.col("size")).otherwise(0)).alias("orphan_bytes"))


def removable(objects: DataFrame, protected: DataFrame) -> DataFrame:
    """Orphans that no retained publication needs."""
    return classify_artifacts(objects).filter("kind = 'orphan'").join(protected.select("object_key"), "object_key", "left_anti")


def retained_publications(publications: DataFrame, current: int, previous: int, now: Column, hours: float = 48.25) -> DataFrame:
    return publications.filter(F.col("id").isin(current, previous) | ~older_than(F.col("created_at"), now, hours))


def protected_files(publications: DataFrame, files: DataFrame) -> DataFrame:
    """Files of all retained publications; one without an index is an error."""
    joined = publications.select("id").join(files, "id", "left")
    return joined.select(F.coalesce("object_key", F.raise_error(F.lit("a publication has no index"))).alias("object_key")).distinct()


def previous_publication(publications: DataFrame) -> DataFrame:
    """(id, previous_id): of each publication the one before it; a publication that is repeated keeps its first place."""
    first = publications.groupBy("source_id", "id").agg(F.min("created_at").alias("created_at"))
    return first.withColumn("previous_id", F.lag("id").over(Window.partitionBy("source_id").orderBy("created_at", "id")))


def expire_snapshots(versions: DataFrame) -> DataFrame:
    """Versions of each table but the newest."""
    newest = versions.groupBy("table_id").agg(F.max("version").alias("newest"))
    return versions.join(newest, "table_id").filter("version < newest").drop("newest")


def publication_health(publications: DataFrame, now: Column, hours: float = 36) -> DataFrame:
    newest = publications.groupBy("source_id").agg(F.max("created_at").alias("created_at"))
    return newest.select("source_id", F.when(older_than(F.col("created_at"), now, hours), "stale").otherwise("fresh").alias("health"))
