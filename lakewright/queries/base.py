"""Registration of queries, and the views over the tables that several of them use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a directory, by attribute: ``t.orders`` reads orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` as a query, with the SQL that gives the same rows."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# The job-result stream, snapshots of a source and stored objects, as views over the tables; the same in SQL.

STATUS = {"signup": "PENDING", "view": "PROCESSING", "purchase": "SUCCESS", "error": "FAILED"}


def messages(t: Tables) -> DataFrame:
    kind = F.lit("DELETED")
    for event, status in STATUS.items():
        kind = F.when(F.col("event_type") == event, status).otherwise(kind)
    number = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    return t.events.select("event_id", "ts", F.col("user_id").alias("resource_id"), F.concat(F.col("user_id"), F.lit(":"), number % 5).alias("job_id"), kind.alias("status"), "value")


MESSAGES = """messages AS (SELECT event_id, ts, user_id AS resource_id, concat(user_id, ':', CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 5) AS job_id,
  CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'PROCESSING' WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'DELETED' END AS status, value FROM events)"""


def resources_prev(t: Tables) -> DataFrame:
    version = F.when(F.col("o_orderkey") % 7 == 0, "v0").otherwise("v1")
    return t.orders.filter(F.col("o_orderkey") % 11 != 0).select(F.lit("s").alias("source_id"), F.col("o_orderkey").alias("id"), version.alias("version"))


def resources(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey") % 13 != 0).select(F.lit("s").alias("source_id"), F.col("o_orderkey").alias("id"), F.lit("v1").alias("version"))


SNAPSHOTS = """prev AS (SELECT 's' AS source_id, o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'v0' ELSE 'v1' END AS version FROM orders WHERE o_orderkey % 11 <> 0),
cur AS (SELECT 's' AS source_id, o_orderkey AS id, 'v1' AS version FROM orders WHERE o_orderkey % 13 <> 0)"""


def jobs(t: Tables) -> DataFrame:
    """Orders as jobs: the customer is the resource, the segment's nation the instance."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("resource_id"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_custkey") % 25).alias("instance_id"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") - 1).alias("parent_job_id"),
        F.col("o_orderpriority").alias("dataset_name"),
        F.col("o_totalprice").alias("size"),
    )


JOBS = """jobs AS (SELECT o_orderkey AS id, o_custkey AS resource_id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, o_orderdate AS created_at,
  o_custkey % 25 AS instance_id, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey - 1 END AS parent_job_id, o_orderpriority AS dataset_name, o_totalprice AS size FROM orders)"""


def objects(t: Tables) -> DataFrame:
    """Parts as stored objects of five kinds of keys."""
    k, n = F.col("p_partkey"), F.col("p_size")
    folder = F.concat(F.lit("r"), n)
    key = (
        F.when(k % 10 < 7, F.concat(folder, F.lit("/ducklake_"), F.lpad(k.cast("string"), 8, "0"), F.lit(".parquet")))
        .when(k % 10 == 7, F.concat(folder, F.lit("/ducklake-"), k, F.lit(".parquet")))
        .when(k % 10 == 8, F.concat(F.lit("main/"), F.lpad(n.cast("string"), 8, "0"), F.lit("-0000-0000-0000-000000000000/"), k, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("main/registry/"), k, F.lit(".parquet")))
    )
    return t.part.select(key.alias("object_key"), F.col("p_retailprice").alias("size"), k.alias("stamp"))


OBJECTS = """objects AS (SELECT CASE WHEN p_partkey % 10 < 7 THEN concat('r', p_size, '/ducklake_', lpad(CAST(p_partkey AS VARCHAR), 8, '0'), '.parquet')
  WHEN p_partkey % 10 = 7 THEN concat('r', p_size, '/ducklake-', p_partkey, '.parquet')
  WHEN p_partkey % 10 = 8 THEN concat('main/', lpad(CAST(p_size AS VARCHAR), 8, '0'), '-0000-0000-0000-000000000000/', p_partkey, '.parquet')
  ELSE concat('main/registry/', p_partkey, '.parquet') END AS object_key, p_retailprice AS size, p_partkey AS stamp FROM part)"""
