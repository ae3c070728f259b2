"""Queries over exploration, paging and bounded SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import explore as E
from ..plans.lake import Lake, preview, preview_columns
from .base import JOBS, Tables, jobs, query

KEY = ("l_orderkey", "l_linenumber")


@query("p1_explore", "SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_quantity > 30 AND contains(CAST(l_returnflag AS VARCHAR), 'A') ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber LIMIT 100 OFFSET 200")
def p1(t: Tables) -> DataFrame:
    return E.explore(t.lineitem, ["l_orderkey", "l_shipdate"], [("l_quantity", "greater", "30"), ("l_returnflag", "contains", "A")], "l_shipdate", True, 200, tie_break=KEY)


def _orders(t: Tables) -> DataFrame:
    """Orders without the lowest priority, which is null instead."""
    return t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


for _name, _filter, _sql in (
    ("equals", ("o_orderstatus", "equals", "F"), "o_orderstatus = 'F'"),
    ("not_equals", ("o_custkey", "notEquals", "7"), "o_custkey <> 7"),
    ("greater", ("o_totalprice", "greater", "100000.5"), "o_totalprice > 100000.5"),
    ("less", ("o_orderdate", "less", "1995-06-01"), "o_orderdate < TIMESTAMP '1995-06-01'"),
    ("contains", ("o_orderkey", "contains", "99"), "contains(CAST(o_orderkey AS VARCHAR), '99')"),
    ("null", ("o_orderpriority", "null"), "o_orderpriority = '5-LOW'"),
    ("not_null", ("o_orderpriority", "notNull"), "o_orderpriority <> '5-LOW'"),
):
    query(f"p2_filter_{_name}", f"SELECT o_orderkey FROM orders WHERE {_sql}")(lambda t, f=_filter: _orders(t).filter(E.predicate(_orders(t), *f)).select("o_orderkey"))


@query("p3_bounded_query", "SELECT l_returnflag, count(*) AS n, false AS truncated FROM lineitem GROUP BY 1")
def p3(t: Tables) -> DataFrame:
    t.lineitem.createOrReplaceTempView("lake_lineitem")
    rows, truncated = E.bounded_query(t.spark, "SELECT l_returnflag, count(*) AS n FROM lake_lineitem GROUP BY 1; ")
    return rows.withColumn("truncated", F.lit(truncated))


@query("p4_bind", "SELECT p_partkey FROM part WHERE p_size > 20 AND p_name LIKE '%a%'")
def p4(t: Tables) -> DataFrame:
    t.part.createOrReplaceTempView("lake_part")
    return t.spark.sql("SELECT p_partkey FROM lake_part WHERE p_size > ? AND p_name LIKE ?", args=E.bind([20, "%a%"]))


for _aggregate, _call in (("count", "count(*)"), ("sum", "sum(l_quantity)"), ("avg", "avg(l_quantity)"), ("min", "min(l_quantity)"), ("max", "max(l_quantity)")):
    query(f"a4_group_{_aggregate}", f"SELECT l_suppkey, {_call} AS valor FROM lineitem WHERE l_discount < 0.05 GROUP BY 1 ORDER BY l_suppkey LIMIT 100")(lambda t, a=_aggregate: E.explore(t.lineitem, filters=[("l_discount", "less", "0.05")], group="l_suppkey", measure="l_quantity", aggregate=a, order="l_suppkey"))


@query(
    "a5_top_by_amount",
    "SELECT l_suppkey AS programme, round(sum(round(l_extendedprice, 2)), 2) AS total FROM lineitem WHERE year(l_shipdate) = 1996 GROUP BY 1 ORDER BY total DESC, programme LIMIT 5",
)
def a5(t: Tables) -> DataFrame:
    shown = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    return E.top_by_amount(t.lineitem, "l_suppkey", shown, F.year("l_shipdate"), 1996)


@query("t2_page", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100")
def t2(t: Tables) -> DataFrame:
    return E.page(t.orders, [F.desc("o_orderdate"), F.col("o_orderkey")], offset=100).select("o_orderkey")


@query("t3_nulls_last", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price FROM orders ORDER BY price NULLS LAST, o_orderkey LIMIT 100 OFFSET 50")
def t3(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("price"))
    return E.explore(rows, order="price", offset=50, tie_break=("o_orderkey",))


@query("t4_top_k", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20")
def t4(t: Tables) -> DataFrame:
    return E.top_k(t.lineitem, [F.desc("l_extendedprice"), *map(F.col, KEY)], 20).select(*KEY)


@query("t5_bounded_result", "SELECT least(count(*), 10000) AS n, count(*) > 10000 AS truncated FROM lineitem")
def t5(t: Tables) -> DataFrame:
    t.lineitem.createOrReplaceTempView("lake_lineitem")
    rows, truncated = E.bounded_query(t.spark, "SELECT l_orderkey FROM lake_lineitem")
    return rows.agg(F.count("*").alias("n")).withColumn("truncated", F.lit(truncated))


@query("t6_number_batches", "SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 300 + 1 AS batch FROM part")
def t6(t: Tables) -> DataFrame:
    return E.number_batches(t.part, "p_partkey", 300).select("p_partkey", "batch")


@query("t1_order_jobs", f"WITH {JOBS} SELECT id FROM (SELECT id, CASE WHEN status <> 'pending' THEN epoch_us(CASE WHEN status IN ('completed', 'failed') THEN created_at + INTERVAL 1 HOUR ELSE TIMESTAMP '1998-08-02' END) - epoch_us(created_at) END AS d, created_at FROM jobs) ORDER BY d DESC NULLS LAST, created_at DESC, id LIMIT 50")
def t1(t: Tables) -> DataFrame:
    rows = jobs(t).withColumn("started", F.when(F.col("status") != "pending", F.col("created_at")))
    end = F.col("created_at") + F.expr("INTERVAL 1 HOUR")
    rows = rows.withColumn("d", S.job_duration(F.col("status"), F.col("started"), end, F.lit("1998-08-02").cast("timestamp")))
    return E.page(rows, [F.col("d").desc_nulls_last(), F.desc("created_at"), F.col("id")]).select("id")


@query("s32_register_and_query", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2")
def s32(t: Tables) -> DataFrame:
    lake = Lake(t.spark)
    lake.register("lines", t.lineitem)
    return lake.query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity FROM lines GROUP BY 1, 2")


@query("a10_table_profile", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows, (SELECT count(*) FROM information_schema.columns WHERE table_name = '{n}') AS n_columns FROM {n}" for n in ("region", "nation", "customer", "orders", "lineitem", "events")))
def a10(t: Tables) -> DataFrame:
    lake = Lake(t.spark)
    for name in ("region", "nation", "customer", "orders", "lineitem", "events"):
        lake.register(name, getattr(t, name))
    return lake.profile()


@query("a11_preview", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN octet_length(encode(text)) > 1000 THEN concat('[', octet_length(encode(text)), ' bytes]') ELSE text END AS text FROM documents ORDER BY documents.doc_id LIMIT 5")
def a11(t: Tables) -> DataFrame:
    return preview(t.documents.orderBy("doc_id").select("doc_id", "lang", "text"))


@query("a12_preview_columns", "SELECT event_id, len(json_keys(props)) AS n FROM events")
def a12(t: Tables) -> DataFrame:
    return t.events.select("event_id", preview_columns(F.concat(F.lit("["), "props", F.lit(",{}]"))).cast("long").alias("n"))
