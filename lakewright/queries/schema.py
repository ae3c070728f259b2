"""Queries over schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import schema as C
from ..operators.statistics import column_statistics, file_footers
from ..sinks.files import write_files
from ..plans.folders import shared_folder
from .base import Tables, query


@query("c1_normalize_names", 'SELECT c_custkey AS "A", c_name AS a__2, c_nationkey AS column_3, c_acctbal AS "A__2__2", c_mktsegment AS b FROM customer')
def c1(t: Tables) -> DataFrame:
    return C.normalize_names(t.customer.toDF("A", "a", " ", "A__2", "b"))


@query("c3_normalize_nulls", "SELECT n_nationkey, CAST(NULL AS VARCHAR) AS nothing FROM nation")
def c3(t: Tables) -> DataFrame:
    return C.normalize_nulls(t.nation.select("n_nationkey", F.lit(None).alias("nothing")))


@query(
    "c4_union_schemas",
    "SELECT CAST(o_custkey AS VARCHAR) AS id, o_totalprice AS amount, o_orderpriority AS note, NULL AS segment FROM orders UNION ALL SELECT c_name, c_acctbal, NULL, c_mktsegment FROM customer",
)
def c4(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("note"))
    b = t.customer.select(F.col("c_name").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment"))
    schema = C.union_schemas([a, b])
    return C.as_schema(a, schema).unionByName(C.as_schema(b, schema))


@query("c5_convert", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, TRY_CAST(l_returnflag AS BIGINT) AS flag, CAST(l_suppkey AS VARCHAR) AS supplier FROM lineitem")
def c5(t: Tables) -> DataFrame:
    kinds = {f.name: f.dataType for f in t.lineitem.schema.fields}
    as_ = lambda c, to: C.convert(F.col(c), kinds[c], to)
    return t.lineitem.select("l_orderkey", "l_linenumber", as_("l_quantity", T.LongType()).alias("quantity"), as_("l_returnflag", T.LongType()).alias("flag"), as_("l_suppkey", T.StringType()).alias("supplier"))


@query("c6_source_file", "SELECT event_id, 'taken' AS __source_file, 'a.zip!/events.csv' AS __source_file_1 FROM events")
def c6(t: Tables) -> DataFrame:
    return C.with_source_file(t.events.select("event_id", F.lit("taken").alias("__source_file")), "a.zip!/events.csv")


@query("c7_source_name", "SELECT page_id, string_split(string_split(url, '?')[1], '/')[-1] AS name FROM (SELECT page_id, regexp_replace(url, '#.*', '') AS url FROM pages)")
def c7(t: Tables) -> DataFrame:
    return t.pages.select("page_id", C.source_name(F.concat(F.lit("outer.zip!/"), "url")).alias("name"))


@query("c9_evolve", "SELECT p_partkey, p_name, CAST(NULL AS INTEGER) AS p_size FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey % 2 = 1")
def c9(t: Tables) -> DataFrame:
    old = t.part.filter("p_partkey % 2 = 0").select("p_partkey", "p_name")
    new = t.part.filter("p_partkey % 2 = 1").select("p_partkey", "p_name", "p_size")
    schema = C.evolve(old.schema, new.schema)
    return C.as_schema(old, schema).unionByName(C.as_schema(new, schema))


@query("c10_drop_empty_lists", "SELECT vec_id, label FROM embeddings")
def c10(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", "label", F.array().cast("array<string>").alias("tags"), F.when(F.lit(False), F.array(F.lit(1))).alias("groups"))
    return C.drop_empty_lists(rows)


@query("c11_list_shapes", "SELECT 'mixed' AS \"column\", 'object,scalar' AS shapes")
def c11(t: Tables) -> DataFrame:
    rows = t.events.select(F.concat(F.lit("["), "props", F.lit("]")).alias("objects"), F.when(F.col("event_id") % 2 == 0, "[1]").otherwise(F.concat(F.lit("["), "props", F.lit("]"))).alias("mixed"))
    return C.list_shapes(rows, ["objects", "mixed"]).select("column", F.array_join("shapes", ",").alias("shapes"))


@query("c12_strict_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def c12(t: Tables) -> DataFrame:
    return t.events.select("event_id", C.strict_from_json(F.col("props"), T.StructType([T.StructField("k", T.DoubleType())]))["k"].alias("k"))


@query("c13_permissive_read", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_phone FROM customer")
def c13(t: Tables) -> DataFrame:
    return C.as_schema(t.customer, T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_phone", T.StringType())]))


@query(
    "u1_merge_children",
    "SELECT o_orderkey AS id, o_totalprice AS left_amount, NULL AS right_amount, 'a.zip!/left.csv' AS __source_file FROM orders UNION ALL SELECT c_custkey, NULL, c_acctbal, 'right.csv' FROM customer",
)
def u1(t: Tables) -> DataFrame:
    left = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("left_amount"))
    right = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("right_amount"))
    return C.merge_children([("a.zip!/left.csv", left), ("right.csv", right)])


@query("c8_geo_children", "SELECT s_suppkey AS id, concat('POINT(', s_suppkey, ' ', s_nationkey, ')') AS geometry, CASE WHEN s_suppkey % 2 = 0 THEN 'a.geojson' ELSE 'b.geojson' END AS __source_file FROM supplier")
def c8(t: Tables) -> DataFrame:
    points = t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("POINT("), "s_suppkey", F.lit(" "), "s_nationkey", F.lit(")")).alias("geometry"))
    geo = [{"version": "1.1.0", "primary_column": "geometry", "bbox": [i, 0, 9, 9]} for i in range(2)]
    return C.merge_children([("a.geojson", points.filter("id % 2 = 0")), ("b.geojson", points.filter("id % 2 = 1"))], geo=geo)


@query(
    "a7_column_statistics",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count(v) AS nulls, CAST(min(v) AS VARCHAR) AS least, CAST(max(v) AS VARCHAR) AS most FROM (SELECT {e} AS v FROM customer)" for c, e in (("c_custkey", "c_custkey"), ("c_mktsegment", "c_mktsegment"), ("half", "CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END"))),
)
def a7(t: Tables) -> DataFrame:
    return column_statistics(t.customer.select("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("half")))


@query("c2_field_ids", "SELECT field, id, rows FROM (VALUES ('c_custkey', 1), ('place.name', 3), ('place.codes.list.element', 5), ('tags.key_value.key', 8), ('tags.key_value.value', 9), ('half', 10)) v(field, id), (SELECT count(*) AS rows FROM customer)")
def c2(t: Tables) -> DataFrame:
    """The ids that the leaves of a nested table have in its Parquet files, with the table's rows."""
    place = F.struct(F.col("c_name").alias("name"), F.array("c_nationkey").alias("codes")).alias("place")
    rows = t.customer.select("c_custkey", place, F.create_map("c_mktsegment", "c_acctbal").alias("tags"), (F.col("c_acctbal") / 2).alias("half"))
    path = shared_folder(t.spark, "ids")
    write_files(rows, path)
    footers = file_footers(t.spark, path).select("n_rows", F.explode("columns").alias("c"))
    return footers.groupBy(F.col("c.path").alias("field"), F.col("c.field_id").alias("id")).agg(F.sum("n_rows").alias("rows"))


@query("a7_file_columns", "SELECT c AS path, i AS field_id, n_rows, CASE c WHEN 'half' THEN odd ELSE 0 END AS null_count, true AS sized FROM (VALUES ('c_custkey', 1), ('c_mktsegment', 2), ('half', 3)) v(c, i), (SELECT count(*) AS n_rows, count(*) FILTER (c_custkey % 2 = 1) AS odd FROM customer)")
def a7_files(t: Tables) -> DataFrame:
    """Figures of the columns of files, summed over files, from their footers; compressed columns are a file but for its footer."""
    path = shared_folder(t.spark, "columns")
    write_files(t.customer.repartition(3, "c_custkey").select("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("half")), path)
    files = file_footers(t.spark, path)
    packed = F.aggregate("columns", F.lit(0).cast("long"), lambda a, c: a + c["size_bytes"])
    rows = files.select("n_rows", ((packed > 0) & (packed < F.col("bytes"))).alias("sized"), F.explode("columns").alias("c"))
    return rows.groupBy("c.path", "c.field_id").agg(F.sum("n_rows").alias("n_rows"), F.sum("c.null_count").alias("null_count"), F.bool_and(F.col("sized") & (F.col("c.size_bytes") > 0)).alias("sized"))


@query("c14_declared_collection", "SELECT n_name AS source_id, n_nationkey::BIGINT AS rank, n_nationkey % 2 = 0 AS even FROM nation")
def c14(t: Tables) -> DataFrame:
    schema = C.ensure_collection("nations", {"source_id": "VARCHAR", "rank": "BIGINT", "even": "BOOLEAN"})
    rows = t.nation.select(F.col("n_name").alias("source_id"), F.col("n_nationkey").cast("string").alias("rank"), (F.col("n_nationkey") % 2 == 0).cast("string").alias("even"))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
