"""Queries over sources."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.explore import ranks
from ..plans.folders import shared_folder
from ..sources import archives, messages, pages, transit
from ..sources import csv as V
from ..sources import json as J
from ..sources import readers
from ..sources import routing as R
from ..sources.logs import number_lines, scan_log
from . import fixtures
from .base import Tables, query

PART = "p_partkey p_name p_brand p_type p_size p_retailprice".split()


@query("s1_scan_csv", "SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN p_name || ';\"' || CASE WHEN p_size % 5 = 1 THEN chr(10) ELSE '' END || p_brand END AS p_name, p_size % 2 = 0 AS even, p_retailprice FROM part")
def s1(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "csv")
    name = F.when(F.col("p_size") % 5 > 0, F.concat("p_name", F.lit(';"'), F.when(F.col("p_size") % 5 == 1, "\n").otherwise(""), "p_brand")).otherwise(" - ")
    t.part.select("p_partkey", name.alias("p_name"), (F.col("p_size") % 2 == 0).alias("even"), "p_retailprice").write.option("header", True).option("sep", ";").option("escape", '"').option("compression", "gzip").csv(path)
    return V.scan_csv(t.spark, path, V.Dialect(";"))


@query("s1_scan_stray_quotes", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' 5\" wide' WHEN 1 THEN p_name || chr(10) || ', \"x\"' WHEN 2 THEN p_name || ' y\"' ELSE p_name END AS p_name, p_size FROM part")
def s1_stray(t: Tables) -> DataFrame:
    """Fields with quotes in the middle, with line breaks, and with text after a closing quote, below a preamble with an open quote."""
    path = shared_folder(t.spark, "csv")
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.concat("p_name", F.lit(' 5" wide'))).when(k == 1, F.concat(F.lit('"'), "p_name", F.lit('\n, ""x"""'))).when(k == 2, F.concat(F.lit('"'), "p_name", F.lit('" y"'))).otherwise(F.col("p_name"))
    line = F.concat_ws(",", "p_partkey", name, "p_size")
    # a partition is a file, and its first row brings the head
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    t.part.select(F.when(first, F.concat(F.lit('"made "by\np_partkey,p_name,p_size\n'), line)).otherwise(line)).write.text(path)
    return V.scan_csv(t.spark, path, V.Dialect(preamble=1))


def _labelled(t: Tables) -> DataFrame:
    """Parts as lines of four files with a delimiter each, after a line of preamble; two of them have a header."""
    k = F.col("p_partkey") % 4
    d = F.element_at(F.array(*[F.lit(x) for x in V.DELIMITERS]), (k + 1).cast("int"))
    fields = F.concat("p_partkey", d, F.lit('"'), "p_name", F.lit('"'), d, "p_brand", d, "p_size")
    rows = t.part.select(F.concat(F.lit("f"), k).alias("file"), (F.floor(F.col("p_partkey") / 4) + 3 - k % 2).cast("long").alias("number"), fields.alias("line"))
    e = F.element_at(F.array(*[F.lit(x) for x in V.DELIMITERS]), (F.col("id") + 1).cast("int"))
    names = t.spark.range(0, 4, 2).select(F.concat(F.lit("f"), "id"), F.lit(2).cast("long"), F.concat(F.lit("key"), e, F.lit("name"), e, F.lit("brand"), e, F.lit("size")))
    return rows.union(names).union(t.spark.range(4).select(F.concat(F.lit("f"), "id"), F.lit(1).cast("long"), F.lit("made by hand")))


@query("s2_sniff_csv", "SELECT p_size % 5 AS file, ['~', ' ', chr(1), ':', ';'][p_size % 5 + 1] AS delimiter, 3 AS width, false AS header, ['UTF-8', 'windows-1252', 'UTF-8', 'windows-1252', 'UTF-8'][p_size % 5 + 1] AS encoding FROM part GROUP BY ALL")
def s2_sniff(t: Tables) -> DataFrame:
    """Files with unusual delimiters, some of them in Windows-1252."""
    path = shared_folder(t.spark, "sniff")
    k = F.col("p_size") % 5
    d = F.get(F.array(*[F.lit(x) for x in ("~", " ", "\x01", ":", ";")]), k)
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    lines = t.part.select(k.alias("k"), F.concat("p_partkey", d, name, F.lit("€é"), d, "p_size").alias("line"))
    text = F.when(F.col("k") % 2 == 1, F.concat(F.encode(F.replace("line", F.lit("€"), F.lit("")), "ISO-8859-1"), F.unhex(F.lit("80")))).otherwise(F.encode("line", "UTF-8"))
    lines.select("k", text.cast("string").alias("line")).repartition("k").write.partitionBy("k").text(path)
    found = V.sniff_csv(t.spark, f"{path}/*/*.txt")
    return found.select(F.regexp_extract("file", "/k=([0-9]+)/", 1).cast("int").alias("file"), "delimiter", "width", "header", "encoding")


@query("s2_profile_csv", "SELECT concat('f', i) AS file, [',', ';', chr(9), '|'][i + 1] AS delimiter, 4 AS width, true AS quoted, 1 AS preamble, i % 2 = 0 AS header, 'UTF-8' AS encoding FROM range(4) r(i)")
def s2(t: Tables) -> DataFrame:
    return V.profile_csv(_labelled(t)).select("file", "delimiter", "width", "quoted", "preamble", "header", "encoding")


@query("s3_infer_types", "SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'string'), ('flag', 'boolean')) v(name, type)")
def s3(t: Tables) -> DataFrame:
    rows = t.orders.select(*[F.col(c).cast("string") for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")], F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("FALSE").alias("flag"))
    return t.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in V.infer_types(rows).fields], "name string, type string")


@query("s4_promote_columns", "SELECT * FROM (VALUES ('l_orderkey', 'bigint', false), ('l_quantity', 'string', false)) v(name, type, strict)")
def s4(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").cast("string"), F.when(F.col("l_quantity") == 17, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"))
    schema, strict = V.promote_columns(rows, T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_quantity", T.DoubleType())]))
    return t.spark.createDataFrame([(f.name, f.dataType.simpleString(), strict) for f in schema.fields], "name string, type string, strict boolean")


def _rows(t: Tables) -> DataFrame:
    """Parts as lines: some with a field too many or too few, some with a bad number, some with an open quote."""
    n = F.col("p_size")
    line = (
        F.when(n % 10 == 1, F.concat_ws(",", "p_partkey", "p_name", "p_brand", "p_size"))
        .when(n % 10 == 2, F.concat_ws(",", "p_partkey", "p_name"))
        .when(n % 10 == 3, F.concat_ws(",", "p_partkey", "p_name", F.lit("x1")))
        .when(n % 10 == 4, F.concat_ws(",", "p_partkey", F.concat(F.lit('"'), "p_name"), "p_size"))
        .otherwise(F.concat_ws(",", "p_partkey", F.concat(F.lit('"'), "p_name", F.lit(', ""q"""')), "p_size"))
    )
    return t.part.select(F.lit("f").alias("file"), (F.col("p_partkey") + 1).alias("number"), line.alias("line"))


SCHEMA = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType()), T.StructField("size", T.LongType())])
PLAIN = V.Dialect(header=False)


@query("s5_rejects", "SELECT p_partkey + 1 AS number, CASE p_size % 10 WHEN 1 THEN 'width' WHEN 2 THEN 'width' WHEN 3 THEN 'type' ELSE 'parser' END AS kind, CASE WHEN p_size % 10 = 3 THEN 'size' END AS \"column\" FROM part WHERE p_size % 10 BETWEEN 1 AND 4")
def s5(t: Tables) -> DataFrame:
    return V.split_malformed(_rows(t), PLAIN, 3, SCHEMA)[1].select("number", "kind", "column")


@query("s5_good_rows", "SELECT p_partkey AS key, p_name || ', \"q\"' AS name, p_size AS size FROM part WHERE p_size % 10 NOT BETWEEN 1 AND 4")
def s5_good(t: Tables) -> DataFrame:
    return V.as_columns(V.split_malformed(_rows(t), PLAIN, 3, SCHEMA)[0], SCHEMA).drop("file", "number")


@query("s6_repair_rows", "SELECT p_partkey + 1 AS number, concat(p_partkey, ',\"', p_name, ',', p_brand, '\",', p_size) AS line FROM part WHERE p_size % 10 = 1")
def s6(t: Tables) -> DataFrame:
    wide = _rows(t).join(t.part.filter("p_size % 10 = 1").select((F.col("p_partkey") + 1).alias("number")), "number", "left_semi")
    return V.repair_rows(wide, wide.select("file", "number", F.lit(2).alias("at")), PLAIN).select("number", "line")


@query("s7_merge_candidates", "SELECT p_partkey + 1 AS number, i AS at, [concat(p_partkey, ',', p_name), concat(p_name, ',', p_brand), concat(p_brand, ',', p_size)][i] AS merged FROM part, range(1, 4) r(i) WHERE p_size % 10 = 1")
def s7(t: Tables) -> DataFrame:
    return V.merge_candidates(V.split_malformed(_rows(t), PLAIN, 3, SCHEMA)[1], PLAIN).drop("file")


def _bodies(t: Tables) -> DataFrame:
    """Events of each user as one JSON document."""
    item = F.struct("event_id", "event_type", "value", F.when(F.col("event_id") % 2 == 0, F.lit("7")).otherwise(F.lit(None)).alias("note"))
    return t.events.groupBy("user_id").agg(F.to_json(F.collect_list(item)).alias("body")).select(F.col("user_id").cast("string").alias("file"), "body")


@query("s8_scan_json", "SELECT event_id, event_type, value, CASE WHEN event_id % 2 = 0 THEN '7' END AS note FROM events")
def s8(t: Tables) -> DataFrame:
    return J.scan_json(_bodies(t)).select("event_id", "event_type", "value", "note")


@query("s9_scan_geojson", """SELECT s_suppkey AS key, s_name AS name, 'Point' AS geometry_type FROM supplier""")
def s9(t: Tables) -> DataFrame:
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).alias("properties"), F.struct(F.lit("Point").alias("type"), F.array("s_acctbal", F.lit(1.5)).alias("coordinates")).alias("geometry"))
    bodies = t.supplier.groupBy("s_nationkey").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("body"))
    return J.scan_geojson(bodies.select(F.col("s_nationkey").cast("string").alias("file"), "body")).select("key", "name", "geometry_type")


@query("s10_scan_gtfs_rt", "SELECT concat('t', o_orderkey) AS id, concat('c', o_custkey) AS route_id, count(l_linenumber) AS stops, -sum(l_partkey) AS delays FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL")
def s10(t: Tables) -> DataFrame:
    """Orders as trips with their lines as stops, in one feed for each order priority and fifty customers."""
    stops = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("stops"))
    trips = t.orders.join(stops, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("feed", F.concat("o_orderpriority", F.lit("-"), F.floor(F.col("o_custkey") / 50)))

    def entities(batches):
        # fields of a message that is written several times are one list: a feed is its header and its entities in a row
        encode = fixtures.encoder(transit.FEED)
        for batch in batches:
            out = []
            for key, cust, numbers, parts in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                entity = {"id": f"t{key}", "trip_update": {"trip": {"trip_id": str(key), "route_id": f"c{cust}"}, "stop_time_update": [{"stop_sequence": n, "arrival": {"delay": -p}} for n, p in zip(numbers, parts, strict=True)]}}
                out.append(encode({"entity": [entity]}))
            yield pa.RecordBatch.from_arrays([batch.columns[0], pa.array(out, pa.binary())], names=["feed", "part"])

    def feed(batches):
        header = fixtures.encode({"header": {"gtfs_realtime_version": "2.0"}}, transit.FEED)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.columns[0], pa.array([header + b"".join(parts) for parts in batch.columns[1].to_pylist()], pa.binary())], names=["file", "content"])

    parts = trips.select("feed", "o_orderkey", "o_custkey", F.col("stops.l_linenumber").alias("numbers"), F.col("stops.l_partkey").alias("parts")).mapInArrow(entities, "feed string, part binary")
    feeds = parts.groupBy(F.col("feed").alias("file")).agg(F.collect_list("part").alias("parts")).mapInArrow(feed, "file string, content binary")
    rows = transit.scan_gtfs_rt(feeds)
    delays = F.aggregate("trip_update.stop_time_update", F.lit(0).cast("long"), lambda a, x: a + x["arrival"]["delay"])
    return rows.select("id", F.col("trip_update.trip.route_id").alias("route_id"), F.size("trip_update.stop_time_update").cast("long").alias("stops"), delays.alias("delays"))


@query("s10_every_field", "SELECT concat('e', o_orderkey) AS id, concat('p', o_orderkey) AS polyline, concat('s', o_custkey) AS stop_name, concat('m', o_orderkey, ',', o_custkey) AS trips, o_custkey AS travel, 'c' AS carriage, concat('http://i/', o_orderkey) AS image, 0.5::DOUBLE AS lat FROM orders")
def s10_every(t: Tables) -> DataFrame:
    """Shapes, stops, trip modifications, carriages and images come through."""

    def feed(frames):
        encode = fixtures.encoder(transit.FEED)
        for df in frames:
            out = []
            for key, cust in zip(df["o_orderkey"], df["o_custkey"], strict=True):
                said = lambda text: {"translation": [{"text": text}]}
                entity = {
                    "id": f"e{key}",
                    "shape": {"encoded_polyline": f"p{key}"},
                    "stop": {"stop_name": said(f"s{cust}"), "stop_lat": 0.5},
                    "trip_modifications": {"selected_trips": [{"trip_ids": [f"m{key}", str(cust)]}], "modifications": [{"replacement_stops": [{"travel_time_to_stop": cust}]}]},
                    "vehicle": {"multi_carriage_details": [{"id": "a"}, {"id": "c", "carriage_sequence": 2}]},
                    "alert": {"image": {"localized_image": [{"url": f"http://i/{key}", "media_type": "image/png"}]}},
                }
                out.append(encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [entity]}))
            yield df[[]].assign(file="f", content=out)

    rows = transit.scan_gtfs_rt(t.orders.select("o_orderkey", "o_custkey").mapInPandas(feed, "file string, content binary"))
    modified = "trip_modifications.modifications"
    return rows.select(
        "id",
        F.col("shape.encoded_polyline").alias("polyline"),
        F.col("stop.stop_name.translation")[0]["text"].alias("stop_name"),
        F.array_join(F.col("trip_modifications.selected_trips")[0]["trip_ids"], ",").alias("trips"),
        F.col(modified)[0]["replacement_stops"][0]["travel_time_to_stop"].alias("travel"),
        F.element_at(F.filter("vehicle.multi_carriage_details", lambda c: c["carriage_sequence"] == 2), 1)["id"].alias("carriage"),
        F.col("alert.image.localized_image")[0]["url"].alias("image"),
        F.col("stop.stop_lat").alias("lat"),
    )


@query("s11_ordered_lines", "SELECT doc_id, i + 1 AS \"order\", ls[i + 1] AS message FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))")
def s11(t: Tables) -> DataFrame:
    lines = t.documents.select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return number_lines(lines.select("file", "line")).select(F.col("file").alias("doc_id"), F.col("number").alias("order"), F.col("line").alias("message"))


@query("s11_scan_log", "SELECT row_number() OVER (PARTITION BY event_type, event_id // 1000 ORDER BY event_id) AS \"order\", concat('<EV=', event_id, ';', event_type, '>') AS message FROM events")
def s11_log(t: Tables) -> DataFrame:
    """A log of each thousand events of a type."""
    path = shared_folder(t.spark, "log")
    log = F.concat_ws("-", F.col("event_type"), F.floor(F.col("event_id") / 1000).cast("string"))
    lines = t.events.select("event_id", log.alias("log"), F.concat(F.lit("<EV="), "event_id", F.lit(";"), "event_type", F.lit(">\r")).alias("line"))
    # folders of one level are listed by one job, not by one for each kind
    lines.repartition("log").sortWithinPartitions("log", "event_id").select("line", "log").write.partitionBy("log").text(path)
    return scan_log(t.spark, path)


@query("s13_datastore_pages", "SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS kind FROM events")
def s13(t: Tables) -> DataFrame:
    record = F.concat(F.lit("["), "event_id", F.when(F.col("event_id") % 3 == 0, ",null]").otherwise(F.concat(F.lit(',"'), "event_type", F.lit('"]'))))
    pages = t.events.groupBy(F.floor(F.col("event_id") / 500).alias("start")).agg(F.concat(F.lit('{"fields":[{"id":"_id"},{"id":"kind"}],"records":['), F.array_join(F.collect_list(record), ","), F.lit("]}")).alias("body"))
    end = t.events.agg((F.max("event_id") + 1).alias("start")).withColumn("body", F.lit('{"fields":[{"id":"_id"},{"id":"kind"}],"records":[]}'))
    return J.scan_datastore_pages(pages.union(end))


def _listing(t: Tables) -> DataFrame:
    """Customers as packages with their orders as resources, in pages."""
    res = F.struct(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.concat(F.lit("http://h/"), "o_orderkey", F.lit(".csv")).alias("url"), F.lit("csv").alias("format"), (F.col("o_orderkey") % 2 == 0).alias("datastore_active"), F.when(F.col("o_orderkey") % 3 == 0, "2024-01-01").alias("last_modified"))
    lists = t.orders.groupBy("o_custkey").agg(F.collect_list(res).alias("resources"))
    package = F.struct(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("").alias("title"), F.lit("2023-05-05").alias("metadata_modified"), "resources")
    rows = t.customer.join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.groupBy(F.floor(F.col("c_custkey") / 25).alias("start")).agg(F.to_json(F.collect_list(package)).alias("body"))


@query("s14_scan_packages", "SELECT concat('c', c_custkey) AS id, c_name AS name FROM customer")
def s14(t: Tables) -> DataFrame:
    return J.scan_packages(_listing(t), "http://portal")[0].select("id", "name")


@query(
    "s15_discover_resources",
    """SELECT concat('c', c_custkey) AS id, NULL AS parent_id, 'collection' AS kind, c_name AS title, '2023-05-05' AS version, NULL AS format, concat('http://portal/dataset/', c_name) AS page_url FROM customer UNION ALL
SELECT concat('o', o_orderkey), concat('c', o_custkey), CASE WHEN o_orderkey % 2 = 0 THEN 'endpoint' ELSE 'file' END, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN '2024-01-01' ELSE '2023-05-05' END, 'CSV', concat('http://portal/dataset/', c_name, '/resource/o', o_orderkey) FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def s15(t: Tables) -> DataFrame:
    packages, resources = J.scan_packages(_listing(t), "http://portal")
    return J.discover_resources(packages, resources, "s", "http://portal").select("id", "parent_id", "kind", "title", "version", "format", "page_url")


@query("s16_archive_rows", "SELECT 'category' AS kind, p_brand AS path FROM part GROUP BY 2 UNION ALL SELECT 'year', concat(p_brand, '/', 2000 + p_size) FROM part GROUP BY 2 UNION ALL SELECT 'file', concat(p_brand, '/', 2000 + p_size, '/', p_partkey, '.csv') FROM part")
def s16(t: Tables) -> DataFrame:
    members = t.part.select(F.col("p_brand").alias("category"), (F.col("p_size") + 2000).alias("year"), F.concat("p_partkey", F.lit(".csv")).alias("member"))
    return archives.discover_archive_resources(members, "s").select("kind", "path")


@query("s18_list_objects", "SELECT concat('folder=', p_size % 7) AS folder, 1 AS files, sum(octet_length(encode(p_name)) + 1)::BIGINT AS size FROM part GROUP BY 1")
def s18(t: Tables) -> DataFrame:
    """Names of parts as text files in folders: a key each, with its bytes."""
    path = shared_folder(t.spark, "objects")
    t.part.select("p_name", (F.col("p_size") % 7).alias("folder")).repartition("folder").write.partitionBy("folder").text(path)
    keys = archives.list_objects(t.spark, path, "*.txt")
    return keys.groupBy(F.regexp_extract("object_key", "/(folder=[0-9]+)/[^/]+$", 1).alias("folder")).agg(F.count("*").cast("int").alias("files"), F.sum("size").alias("size"))


@query("s19_file_references", "SELECT page_id AS id, CASE WHEN nullif(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[-1], '') IS NULL THEN concat(page_id, '.pdf') ELSE string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[-1] END AS name FROM pages WHERE page_id % 2 = 0")
def s19(t: Tables) -> DataFrame:
    rows = t.pages.select(F.col("page_id").alias("id"), "url", F.lit(None).cast("string").alias("file_name"), F.when(F.col("page_id") % 2 == 0, "pdf").otherwise("csv").alias("format"))
    return pages.file_references(rows).select("id", "name")


@query("s20_expand_archives", "SELECT p_brand AS archive, concat(p_partkey, '.csv') AS member, octet_length(encode(p_name)) AS bytes FROM part")
def s20(t: Tables) -> DataFrame:
    members = t.part.select(F.col("p_brand").alias("archive"), F.concat("p_partkey", F.lit(".csv")).alias("member"), F.col("p_name").alias("text"))
    files = fixtures.pack_archives(members, shared_folder(t.spark, "zip"))
    return archives.expand_archives(archives.read_archives(t.spark, files), "CSV").select(F.regexp_extract("label", r"([^/]+)\.zip!/", 1).alias("archive"), F.regexp_extract("label", "!/(.*)$", 1).alias("member"), F.octet_length("content").cast("long").alias("bytes"))


@query("s21_unsafe_members", "SELECT p_partkey FROM part WHERE p_size % 8 BETWEEN 1 AND 6")
def s21(t: Tables) -> DataFrame:
    names = ["/abs", "a/../b", "a\\b", "a:b", "", "x!y"]
    n = F.col("p_size") % 8
    name = F.when(n.between(1, 6), F.element_at(F.array(*[F.lit(x) for x in names]), n.cast("int"))).otherwise(F.concat("p_partkey", F.lit(".csv")))
    rows = t.part.select("p_partkey", F.col("p_partkey").alias("archive"), name.alias("member"), F.lit(False).alias("symlink"))
    return archives.unsafe_members(rows).select("p_partkey")


LINKS = "links AS (SELECT DISTINCT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || unnest(regexp_extract_all(html, '<a href=\"(/[^\"]*)\"', 1)) AS target FROM pages)"


@query("s22_extract_links", f"WITH {LINKS} SELECT DISTINCT url, target FROM links UNION SELECT url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/my%20file%20' || page_id || '.csv' FROM pages")
def s22(t: Tables) -> DataFrame:
    link = F.concat(F.lit("<p><a class='x' href=' /my file "), "page_id", F.lit(".csv'>file</a>"))
    return pages.extract_links(t.pages.withColumn("html", F.concat("html", link)))


@query("s23_classify_links", f"WITH {LINKS} SELECT target, min(CASE WHEN contains(string_split(target, '/')[-1], '.') THEN 'drop' ELSE 'page' END) AS kind FROM links GROUP BY 1")
def s23(t: Tables) -> DataFrame:
    return pages.classify_links(pages.extract_links(t.pages), "CSV")


@query(
    "s24_crawl_frontier",
    "WITH RECURSIVE walk AS (SELECT 0 AS k, 0 AS depth UNION ALL SELECT p.k * 2 + i, depth + 1 FROM walk p, range(1, 3) r(i) WHERE depth < 4 AND p.k * 2 + i < (SELECT count(*) FROM pages)) SELECT concat('http://h/', k) AS url, min(depth) AS depth FROM walk GROUP BY 1",
)
def s24(t: Tables) -> DataFrame:
    """Pages as a binary tree of links, with links back to the root, and to captured pages of another host and with a file's name."""
    numbered = ranks(t.pages.select("page_id"), "page_id", "k", 0)
    link = lambda x: F.concat(F.lit("<A HREF='"), x, F.lit("#top'>x</A>"))
    k = F.col("k").cast("string")
    here, other, file = F.concat(F.lit("/"), k), F.concat(F.lit("http://other/"), k), F.concat(F.lit("/"), k, F.lit(".html"))
    child = lambda i: F.concat(F.lit("/"), F.col("k") * 2 + i)
    html = F.concat(link(child(1)), link(child(2)), link(F.lit("/0")), link(other), link(file))
    made = numbered.select(F.explode(F.array(F.concat(F.lit("http://h"), here), other, F.concat(F.lit("http://h"), file))).alias("url"), html.alias("html"))
    return pages.crawl_frontier(made, made.filter("url = 'http://h/0'").select("url"))


@query(
    "s24_crawl_sources",
    """SELECT page_id AS id, kind, target FROM (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS host, unnest(['file', 'archive', 'drive folder', 'drive file']) AS kind FROM pages),
LATERAL (SELECT CASE kind WHEN 'file' THEN concat(host, '/data/', page_id, '.CSV?v=1') WHEN 'archive' THEN concat(host, '/all.zip') WHEN 'drive folder' THEN concat('https://drive.google.com/drive/folders/f', page_id, '?resourcekey=k') ELSE concat('https://drive.google.com/uc?export=download&id=', page_id) END AS target)""",
)
def s24_sources(t: Tables) -> DataFrame:
    """Pages with links to a file, an archive twice, a shared folder and file, and to what is no source."""
    k = F.col("page_id").cast("string")
    link = lambda *parts: F.concat(F.lit("<a href='"), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("'>x</a>"))
    links = F.concat(link("/data/", k, ".CSV?v=1"), link("/all.zip"), link("/all.zip#top"), link("https://drive.google.com/drive/folders/f", k, "?resourcekey=k"), link("https://drive.google.com/uc?export=download&amp;id=", k), link("https://drive.google.com/about"), link("/data/", k, ".json"))
    made = t.pages.select(F.col("page_id").alias("id"), F.col("url").alias("root"), "url", F.concat(F.coalesce("html", F.lit("")), links).alias("html"))
    return pages.crawl_sources(made, "CSV")


@query("s25_drive_links", "SELECT url, CASE WHEN page_id % 6 IN (2, 3) THEN 'folder' ELSE 'file' END AS kind, concat('id_', page_id) AS drive_id, CASE WHEN page_id % 6 IN (3, 5) THEN concat('k ', page_id) END AS resource_key FROM pages WHERE page_id % 6 > 1")
def s25(t: Tables) -> DataFrame:
    n = F.col("page_id")
    forms = ["https://other.example/file/d/id_{}", "https://drive.google.com/file/d/id.{}/view", "https://drive.google.com/drive/u/0/folders/id_{}", "https://drive.google.com/drive/folders/id_{}?resourcekey=k%20{}", "https://drive.google.com/file/d/id_{}/view", "https://drive.google.com/open?resourcekey=k+{}&amp;id=id_{}"]
    link = F.replace(F.element_at(F.array(*[F.lit(x) for x in forms]), (n % 6 + 1).cast("int")), F.lit("{}"), n.cast("string"))
    return pages.extract_drive_links(t.pages.select("url", F.concat(F.lit('<p><a class=x href="'), link, F.lit('">d</a>')).alias("html")))


@query("s29_eligible_readers", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'datastore,csv' WHEN 1 THEN 'csv' WHEN 2 THEN 'json' ELSE 'file_reference,crawler' END AS readers FROM documents")
def s29(t: Tables) -> DataFrame:
    n = F.col("doc_id") % 4
    rows = t.documents.select("doc_id", F.element_at(F.array(F.lit("CSV"), F.lit("text/csv"), F.lit("GeoJSON"), F.lit("HTML")), (n + 1).cast("int")).alias("format"), F.lit("http://x").alias("url"), (n == 0).alias("datastore_active"), F.lit("d").alias("file_name"))
    return rows.select("doc_id", F.array_join(R.eligible_readers(), ",").alias("readers"))


@query("s28_ingest_resources", "SELECT doc_id AS id, CASE doc_id % 4 WHEN 3 THEN 'unsupported' WHEN 2 THEN 'failed' ELSE 'completed' END AS status, CASE doc_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' END AS reader FROM documents")
def s28(t: Tables) -> DataFrame:
    n = F.col("doc_id") % 4
    rows = t.documents.select(F.col("doc_id").alias("id"), F.when(n == 3, "xyz").when(n == 2, "json").otherwise("csv,json").alias("format"), F.lit("http://x").alias("url"), F.lit(False).alias("datastore_active"), F.lit("d").alias("file_name"))
    csv = R.Reader("csv", R.can_read("csv"), lambda df: df.select("id", F.when(F.col("id") % 4 == 0, 5).otherwise(0).alias("rows"), F.lit(None).cast("string").alias("error")))
    json = R.Reader("json", R.can_read("json"), lambda df: df.select("id", F.when(F.col("id") % 4 == 1, 3).otherwise(0).alias("rows"), F.when(F.col("id") % 4 == 2, "bad").alias("error")))
    return R.ingest_resources(rows, [csv, json]).select("id", "status", "reader")


#: Readings of the fixtures: a customer's reader, columns, and what became of it.
READ = """k AS (SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT c_custkey AS key, c_custkey % 10 AS m, c_custkey % 20 AS m2, n FROM customer LEFT JOIN k ON c_custkey = key),
v AS (SELECT key, CASE WHEN m2 = 18 OR m = 9 OR (m < 9 AND m <> 6 AND n IS NULL) THEN 'FAILED' WHEN m = 8 THEN 'DELETED' ELSE 'SUCCESS' END AS status, ['datastore', 'csv', CASE WHEN m2 = 12 THEN 'json' ELSE 'datapackage' END, 'json', 'protobuf', 'log', 'file_reference', 'crawler', NULL, NULL][m + 1] AS reader,
  CASE m WHEN 6 THEN 1 ELSE n END AS n, [3, 3, CASE WHEN m2 = 12 THEN 2 ELSE 17 END, 5, 2, 2, 2, 3, NULL, NULL][m + 1] AS columns, m, m2 FROM r)"""


@query(
    "s28_ingest_tables",
    f"""WITH {READ} SELECT key AS resource_id, CASE WHEN status = 'SUCCESS' THEN reader END AS reader, status, CASE WHEN status = 'SUCCESS' THEN n ELSE 0 END AS rows_processed, CASE WHEN status = 'SUCCESS' THEN columns END::BIGINT AS columns,
CASE WHEN status = 'SUCCESS' THEN NULL WHEN m2 = 18 THEN 'unsupported' WHEN m = 8 AND n IS NOT NULL THEN 'csv: HTTP 404' WHEN m = 9 AND n IS NOT NULL THEN 'csv: line 4: 3 fields for 2; json: no JSON document'
WHEN m = 9 THEN 'csv: no rows; json: no rows' WHEN m = 0 THEN 'datastore: no rows; csv: no rows' WHEN m = 2 THEN 'datapackage: no rows; json: no rows' ELSE concat(CASE m WHEN 8 THEN 'csv' ELSE reader END, ': no rows') END AS error_message
FROM v""",
)
def s28_tables(t: Tables) -> DataFrame:
    """All customers as resources through the eight readers, each to a table of its own."""
    outcomes, _ = readers.ingest_tables(fixtures.resources(t), fixtures.captures(t), shared_folder(t.spark, "tables"), "v1")
    return outcomes.select("resource_id", "reader", "status", "rows_processed", "columns", "error_message")


@query(
    "s28_table_rows",
    """SELECT o_custkey AS resource_id, CASE m WHEN 5 THEN concat('<EV=', o_orderkey, '>') WHEN 4 THEN concat('e', o_orderkey) ELSE concat(o_orderkey) END AS key, CASE m WHEN 1 THEN o_orderstatus || '" x' WHEN 3 THEN 'Point' WHEN 0 THEN o_orderstatus END AS text,
CASE WHEN m IN (1, 3) THEN o_totalprice END AS price, CASE m WHEN 4 THEN o_orderkey END AS stamp FROM (SELECT *, o_custkey % 10 AS m FROM orders) WHERE m IN (0, 1, 3, 4, 5)""",
)
def s28_rows(t: Tables) -> DataFrame:
    """The tables of five readers read back, a folder a resource."""
    root = shared_folder(t.spark, "tables")
    _, files = readers.ingest_tables(fixtures.resources(t), fixtures.captures(t), root, "v1")
    # every resource has its own folder; those of one reader and one set of columns are read together
    wanted = {0: ("key string, status string, price string", ("key", "status", None, None)), 1: ("key long, status string, price double", ("key", "status", "price", None)), 3: ("key long, tags array<string>, price double, geometry string, geometry_type string", ("key", "geometry_type", "price", None)), 4: ("id string, vehicle struct<timestamp:long>", ("id", None, None, "vehicle.timestamp")), 5: ("order long, message string", ("message", None, None, None))}
    files.count()
    out = []
    for digit, (schema, columns) in wanted.items():
        rows = t.spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{root}/*{digit}/*")
        names = (("key", "string"), ("text", "string"), ("price", "double"), ("stamp", "long"))
        cells = [(F.lit(None) if c is None else F.col(c)).cast(kind).alias(name) for c, (name, kind) in zip(columns, names, strict=True)]
        out.append(rows.select(F.regexp_extract("_metadata.file_path", "/([0-9]+)/ducklake_", 1).cast("long").alias("resource_id"), *cells))
    return reduce(DataFrame.unionByName, out)


@query("s30_cache_decision", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'fetch' WHEN ts > m - INTERVAL 7 DAY THEN 'fresh' WHEN event_id % 2 = 0 OR event_id % 5 > 0 THEN 'reuse' ELSE 'fetch' END AS decision FROM events, (SELECT max(ts) AS m FROM events)")
def s30(t: Tables) -> DataFrame:
    now = t.events.agg(F.max("ts")).first()[0]
    e = F.col("event_id")
    sources = t.events.select("event_id", F.when(e % 2 == 1, F.when(e % 5 > 0, F.col("ts")).otherwise(F.col("ts") + F.expr("INTERVAL 1 HOUR"))).alias("last_modified"))
    cache = t.events.filter("event_id % 3 > 0").select("event_id", F.col("ts").alias("uploaded_at"))
    return R.cache_decision(sources, cache, "event_id", F.lit(now)).select("event_id", "decision")


@query(
    "s30_archive_decision",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'fetch' WHEN event_id % 13 = 0 THEN 'reuse' WHEN event_id % 2 = 0 AND event_id % 5 > 0 THEN CASE WHEN ts > m - INTERVAL 7 DAY THEN 'reuse' ELSE 'fetch' END
WHEN event_id % 10 = 5 AND event_id % 4 = 1 THEN 'fetch' ELSE 'reuse' END AS decision FROM events, (SELECT max(ts) AS m FROM events)""",
)
def s30_archives(t: Tables) -> DataFrame:
    """Odd archives tell when they were modified, every fifth tells a tag, and some of those that tell both have a new one."""
    now = t.events.agg(F.max("ts")).first()[0]
    e = F.col("event_id")
    tag = F.when(e % 5 == 0, F.when((e % 2 == 1) & (e % 4 == 1), "new").otherwise("old"))
    sources = t.events.select("event_id", F.when(e % 2 == 1, F.col("ts")).alias("last_modified"), tag.alias("etag"), F.lit(True).alias("archive"), (e % 13 != 0).alias("answered"))
    cache = t.events.filter("event_id % 3 > 0").select("event_id", F.col("ts").alias("uploaded_at"), F.col("ts").alias("origin_modified"), F.lit("old").alias("origin_etag"))
    return R.cache_decision(sources, cache, "event_id", F.lit(now)).select("event_id", "decision")


@query("s31_read_messages", "SELECT event_id, event_type AS status, value FROM events WHERE event_type <> 'click' UNION ALL SELECT event_id, 'again', value FROM events WHERE event_type <> 'view'")
def s31(t: Tables) -> DataFrame:
    """A log in three appends: all of the first two, read by offsets up to the second, and a stream from there on that stopped after each append."""
    path = shared_folder(t.spark, "messages")
    out = f"{path}-read"
    schema = "event_id long, status string, value double"
    row = lambda df, status: df.select(F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id", status.alias("status"), "value")).alias("value"))
    status = F.col("event_type")
    messages.write_messages(row(t.events.filter("event_type = 'view'"), status), path)
    messages.write_messages(row(t.events.filter("event_type NOT IN ('view', 'click')"), status), path)
    ends = {r["partition"]: r["n"] + 1 for r in messages.read_messages(t.spark, path, schema).groupBy("partition").agg(F.max("offset").alias("n")).collect()}  # one row a partition
    for kind in ("click", "purchase", "signup", "error"):
        messages.write_messages(row(t.events.filter(F.col("event_type") == kind), F.lit("again")), path)
        stream = messages.read_messages(t.spark, path, schema, stream=True, start=ends).select("event_id", "status", "value")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    first = messages.read_messages(t.spark, path, schema, end=ends).select("event_id", "status", "value")
    return first.unionByName(t.spark.read.schema(schema).parquet(out))


@query("s12_scan_datapackage", "SELECT concat('part-', p_partkey) AS name, p_type AS title, floor(p_retailprice)::BIGINT AS bytes, 'parts' AS package_id FROM part")
def s12(t: Tables) -> DataFrame:
    """Parts as resources of data packages of a hundred each, so that no package grows with the table."""
    resource = F.struct(F.concat(F.lit("part-"), "p_partkey").alias("name"), F.col("p_type").alias("title"), F.floor("p_retailprice").alias("bytes"))
    bodies = t.part.groupBy(F.floor(F.col("p_partkey") / 100).alias("g")).agg(F.to_json(F.struct(F.collect_list(resource).alias("resources"))).alias("body"))
    return J.scan_datapackage(bodies.select(F.lit("x/datapackage.json").alias("file"), "body"), "parts").select("name", "title", "bytes", "package_id")
