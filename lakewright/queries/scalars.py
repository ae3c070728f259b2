"""Queries over the column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .base import Tables, query

NOW = "1998-08-02 00:00:00"
NOW_LIT = lambda: F.lit(NOW).cast("timestamp")


@query("f1_clean_text", "SELECT p_partkey, lower(trim(regexp_replace(concat('  ', p_name, '  x '), '\\s+', ' ', 'g'))) AS cleaned, upper(p_brand) AS brand, left(p_type, 5) AS head, contains(p_type, 'STEEL') AS steel, string_split(p_type, ' ')[1] AS word FROM part")
def f1(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.clean_text(F.concat(F.lit("  "), "p_name", F.lit("  x "))).alias("cleaned"), F.upper("p_brand").alias("brand"), F.left("p_type", F.lit(5)).alias("head"), F.col("p_type").contains("STEEL").alias("steel"), F.split("p_type", " ")[0].alias("word"))


@query("f2_truncate_text", "SELECT doc_id, octet_length(encode(text)) <= 1000 AS short, CASE WHEN octet_length(encode(text)) <= 1000 THEN text ELSE left(text, list_max(list_filter(range(250, 1001), lambda n: octet_length(encode(left(text, n))) <= 1000))) END AS cut FROM documents")
def f2(t: Tables) -> DataFrame:
    cut = S.truncate_text(F.col("text"), 1000)
    return t.documents.select("doc_id", (cut == F.col("text")).alias("short"), cut.alias("cut"))


@query("f3_like_any", "SELECT p_partkey FROM part WHERE p_name LIKE '%an%' OR p_type LIKE '%S_E%'")
def f3(t: Tables) -> DataFrame:
    return t.part.filter(S.like_any("an", F.col("p_name")) | S.like_any("S_E", F.col("p_type"))).select("p_partkey")


@query("f4_fold_accents", "SELECT doc_id, strip_accents(lower(text)) AS folded FROM documents")
def f4(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.fold_accents(F.col("text")).alias("folded"))


@query("f5_parse_local_number", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS amount FROM lineitem")
def f5(t: Tables) -> DataFrame:
    shown = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    return t.lineitem.select("l_orderkey", "l_linenumber", S.parse_local_number(shown).alias("amount"))


@query("f6_urls", r"SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host, nullif(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')[-1], '') AS name, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/a/b' AS link FROM pages")
def f6(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select("page_id", S.url_host(url).alias("host"), S.url_name(url).alias("name"), S.resolve_url(url, F.lit("/x/../a/./b#part")).alias("link"))


@query("f7_portal_urls", "SELECT c_custkey, concat('http://portal/dataset/', c_mktsegment) AS dataset, concat('http://portal/dataset/', c_mktsegment, '/resource/', c_custkey) AS resource FROM customer")
def f7(t: Tables) -> DataFrame:
    base = F.lit("http://portal//")
    return t.customer.select("c_custkey", S.dataset_url(base, F.col("c_mktsegment")).alias("dataset"), S.resource_url(base, F.col("c_mktsegment"), F.col("c_custkey")).alias("resource"))


@query("f8_json", """SELECT event_id, json_extract_string(props, '$.k') AS k, len(json_keys(props)) AS n_keys, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS canonical FROM events""")
def f8(t: Tables) -> DataFrame:
    props = F.col("props")
    return t.events.select("event_id", S.json_text(props, "$.k").alias("k"), S.json_key_count(props).cast("long").alias("n_keys"), S.canonical_json(props).alias("canonical"))


@query("f9_as_json_text", """SELECT n_nationkey, concat('{"key":', n_nationkey, ',"name":"', n_name, '"}') AS whole, CAST(n_regionkey AS VARCHAR) AS plain FROM nation""")
def f9(t: Tables) -> DataFrame:
    whole = F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return t.nation.select("n_nationkey", S.as_json_text(whole, "struct").alias("whole"), S.as_json_text(F.col("n_regionkey")).alias("plain"))


@query("f10_times", "SELECT event_id, epoch_us(ts) // 1000000 AS rfc, epoch_us(ts) // 1000000 AS http, strftime(ts, '%Y%m%dT%H%M%S') AS compact, true AS no_zone FROM events")
def f10(t: Tables) -> DataFrame:
    rfc = S.parse_rfc3339(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    http = S.parse_http_date(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    return t.events.select("event_id", F.unix_seconds(rfc).alias("rfc"), F.unix_seconds(http).alias("http"), S.compact_id(F.col("ts")).alias("compact"), S.parse_rfc3339(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).isNull().alias("no_zone"))


@query("f11_durations", "SELECT l_orderkey, l_linenumber, us, concat_ws(' ', CASE WHEN us // 3600000000 > 0 THEN concat(us // 3600000000, 'h') END, CASE WHEN us // 60000000 > 0 THEN concat(us // 60000000 % 60, 'm') END, concat(us // 1000000 % 60, 's')) AS shown FROM (SELECT *, greatest(0, epoch_us(TIMESTAMP '1998-08-02') - epoch_us(l_shipdate)) AS us FROM lineitem)")
def f11(t: Tables) -> DataFrame:
    us = S.job_duration(F.lit("processing"), F.col("l_shipdate"), F.lit(None).cast("timestamp"), NOW_LIT())
    return t.lineitem.select("l_orderkey", "l_linenumber", us.alias("us"), S.format_duration(us).alias("shown"))


@query("f12_older_than", "SELECT event_id, ts < (SELECT max(ts) FROM events) - INTERVAL 36 HOUR AS stale, ts < (SELECT max(ts) FROM events) - INTERVAL 7 DAY AS week FROM events")
def f12(t: Tables) -> DataFrame:
    newest = t.events.agg(F.max("ts").alias("now"))
    return t.events.join(F.broadcast(newest)).select("event_id", S.older_than(F.col("ts"), F.col("now"), 36).alias("stale"), S.older_than(F.col("ts"), F.col("now"), 168).alias("week"))


@query("f13_stable_id", """SELECT o_orderkey, concat(left(h, 8), '-', h[9:12], '-5', h[14:16], '-', ['8', '9', 'a', 'b'][CAST(('0x' || h[17]) AS INTEGER) % 4 + 1], h[18:20], '-', h[21:32]) AS id
FROM (SELECT o_orderkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat('orders:', o_orderkey))) AS h FROM orders)""")
def f13(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", S.stable_id(F.concat(F.lit("orders:"), "o_orderkey")).alias("id"))


@query("f14_digest", "SELECT doc_id, sha256(text) AS digest, octet_length(encode(text)) AS bytes FROM documents")
def f14(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


@query("f15_sizes", "SELECT l_orderkey, l_linenumber, CASE WHEN s < 1048576 THEN 'small' WHEN s < 1073741824 THEN 'medium' ELSE 'large' END AS bucket, greatest(1, least(32768, 4194304 // greatest(1, l_partkey))) AS batch FROM (SELECT *, CAST(l_extendedprice * 20000 AS BIGINT) AS s FROM lineitem)")
def f15(t: Tables) -> DataFrame:
    size = F.round(F.col("l_extendedprice") * 20000).cast("long")
    return t.lineitem.select("l_orderkey", "l_linenumber", S.size_bucket(size).alias("bucket"), S.rows_per_batch(F.col("l_partkey")).alias("batch"))


@query("f15_size_text", "SELECT DISTINCT CASE WHEN k < 1024 THEN printf('%.1f KB', round(k, 1)) ELSE printf('%.1f MB', round(k / 1024, 1)) END AS shown FROM (SELECT CAST(p_size AS DOUBLE) * 64 AS k FROM part)")
def f15_text(t: Tables) -> DataFrame:
    return t.part.select(S.size_text(F.col("p_size").cast("double") * 65536).alias("shown")).distinct()


@query("f16_arrays", "SELECT vec_id, len(embedding) AS n, list_max(embedding) AS most, len(list_distinct(list_transform(embedding, lambda x: x > 0))) AS signs FROM embeddings")
def f16(t: Tables) -> DataFrame:
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.size(e).cast("long").alias("n"), F.array_max(e).alias("most"), F.size(F.array_distinct(F.transform(e, lambda x: x > 0))).cast("long").alias("signs"))


@query("f16_pick_fields", "SELECT n_regionkey, list_sort(list(n_name)) AS names FROM nation GROUP BY 1")
def f16_pick(t: Tables) -> DataFrame:
    rows = t.nation.groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("items"))
    return rows.select("n_regionkey", F.array_sort(F.transform(S.pick_fields(F.col("items"), ["n_name"]), lambda x: x["n_name"])).alias("names"))


@query("f17_is_uuid", "SELECT p_partkey, p_partkey % 2 = 0 AS uuid FROM part")
def f17(t: Tables) -> DataFrame:
    name = F.when(F.col("p_partkey") % 2 == 0, S.stable_id(F.col("p_partkey").cast("string"))).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", S.is_uuid(name).alias("uuid"))


@query("f18_first_text", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_brand ELSE p_type END AS title FROM part")
def f18(t: Tables) -> DataFrame:
    n = F.col("p_size") % 3
    return t.part.select("p_partkey", S.first_text(F.when(n == 0, F.col("p_name")).otherwise("  "), F.when(n == 1, F.col("p_brand")), F.col("p_type")).alias("title"))


BYTES = f"[{', '.join(str(ord(S.WINDOWS_1252.get(i, chr(i)))) for i in range(256))}]"


@query("f19_decode_bytes", f"SELECT doc_id, md5(text) AS utf8, md5(text) AS utf16, {BYTES}[doc_id % 256 + 1] AS code FROM documents")
def f19(t: Tables) -> DataFrame:
    """Texts in UTF-8 with a mark and in UTF-16, and all bytes in turn, each before one that no UTF-8 text has there."""
    utf8 = S.decode_bytes(F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
    utf16 = S.decode_bytes(F.encode("text", "UTF-16"), "UTF-16")
    one = S.decode_bytes(F.unhex(F.concat(F.lpad(F.hex(F.col("doc_id") % 256), 2, "0"), F.lit("FF"))))
    return t.documents.select("doc_id", F.md5(F.encode(utf8, "UTF-8")).alias("utf8"), F.md5(F.encode(utf16, "UTF-8")).alias("utf16"), F.ascii(F.substring(one, 1, 1)).alias("code"))


@query("f20_status_label", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'other' END AS label FROM orders")
def f20(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "pending").otherwise("other")
    return t.orders.select("o_orderkey", S.status_label(status).alias("label"))


@query("s26_matches_format", "SELECT page_id, page_id % 4 IN (0, 1) AS json, page_id % 4 = 2 AS tiff FROM pages")
def s26(t: Tables) -> DataFrame:
    name = F.concat(F.lit("f."), F.element_at(F.array(F.lit("JSON"), F.lit("geojson"), F.lit("TIF"), F.lit("xlsx")), (F.col("page_id") % 4 + 1).cast("int")))
    return t.pages.select("page_id", S.matches_format(name, "JSON").alias("json"), S.matches_format(name, "tif/tiff").alias("tiff"))


@query("s27_infer_format", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'XLSX' WHEN 2 THEN 'PDF' END AS format FROM documents")
def s27(t: Tables) -> DataFrame:
    n = F.col("doc_id") % 4
    kind = F.when(n == 0, "text/csv; charset=utf-8").when(n == 1, "application/octet-stream")
    return t.documents.select("doc_id", S.infer_format(kind, F.when(n == 1, 'attachment; filename="a.b.xlsx"'), F.when(n == 2, "pdf").otherwise(" ")).alias("format"))
