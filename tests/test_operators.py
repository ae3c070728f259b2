"""Operators on small made inputs: errors, edge cases and files that SQL can't make."""

import datetime
import json
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import scalars as S
from lakewright.operators import catalogue, explore, ledger, schema, statistics
from lakewright.plans import folders
from lakewright.plans.state import StateTable
from lakewright.queries import fixtures
from lakewright.sinks import files as K
from lakewright.sources import archives, csv, pages, routing, transit
from lakewright.sources import json as J


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_unique_names():
    assert schema.unique_names(["", "a", "A", "a", " ", "a__2"]) == ["column_1", "a", "A__2", "a__3", "column_5", "a__2__2"]


def test_field_ids_are_depth_first(spark):
    kind = T._parse_datatype_string("a struct<b:int,c:array<struct<d:int>>>, e string")
    out = schema.assign_field_ids(kind)
    ids = lambda f: f.metadata["parquet.field.id"]
    inner = out["a"].dataType
    assert [ids(out["a"]), ids(inner["b"]), ids(inner["c"]), ids(inner["c"].dataType.elementType["d"]), ids(out["e"])] == [1, 2, 3, 5, 6]
    assert inner["c"].metadata["parquet.field.nested.ids"] == {"element": 4}


def test_geo_inputs_must_agree():
    schema.check_geo([{"a": 1, "bbox": [0]}, {"a": 1, "bbox": [1]}])
    schema.check_geo([None, None])
    for bad in ([{"a": 1}, None], [{"a": 1}, {"a": 2}]):
        with pytest.raises(ValueError):
            schema.check_geo(bad)


def test_collections_are_declared_rightly():
    assert schema.ensure_collection("notes", {"source_id": "VARCHAR", "n": "BIGINT"})["n"].dataType == T.LongType()
    for name, columns in (("Bad", {"source_id": "VARCHAR"}), ("catalog_x", {"source_id": "VARCHAR"}), ("ok", {}), ("ok", {"source_id": "VARCHAR", "x": "BLOB"})):
        with pytest.raises(ValueError):
            schema.ensure_collection(name, columns)


def test_strict_json_rejects_unknown_fields(spark):
    df = spark.createDataFrame([('{"k":1,"z":2}',)], "c string")
    with pytest.raises(Exception, match="unknown fields: z"):
        df.select(schema.strict_from_json(F.col("c"), T.StructType([T.StructField("k", T.LongType())]))).collect()


def test_explore_errors(spark):
    df = spark.range(3).withColumn("weird\"`x", F.lit(1))
    assert explore.explore(df, ['weird"`x'], order="id").count() == 3
    for call in (dict(columns=["no"]), dict(offset=-1), dict(group="id", aggregate="median"), dict(filters=[("id", "like", "x")])):
        with pytest.raises(ValueError):
            explore.explore(df, **call)
    with pytest.raises(ValueError):
        explore.page(df, [F.col("id")], 501)
    with pytest.raises(ValueError):
        explore.bind([float("nan")])
    for sql in ("DROP TABLE x", "SELECT 1; SELECT 2"):
        with pytest.raises(ValueError):
            explore.bounded_query(spark, sql)
    rows, more = explore.bounded_query(spark, "SELECT id FROM range(20)", limit=5)
    assert rows.count() == 5 and more


def test_ranks_equal_row_numbers(spark):
    rows = explore.ranks(spark.range(0, 1000, 3, 7).withColumn("id", F.col("id") * 7919 % 1009), "id").orderBy("id").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def test_http_dates_and_zones(spark):
    assert one(spark, S.parse_http_date(F.lit("Sun, 06 Nov 1994 08:49:37 GMT"))) == datetime.datetime(1994, 11, 6, 8, 49, 37)
    assert one(spark, S.parse_rfc3339(F.lit("2024-02-03T04:05:06+02:00"))) == datetime.datetime(2024, 2, 3, 2, 5, 6)
    assert one(spark, S.parse_rfc3339(F.lit("2024-02-03T04:05:06"))) is None
    assert one(spark, S.parse_http_date(F.lit("yesterday"))) is None


def test_stable_ids_are_uuid5(spark):
    import uuid

    for name in ("", "a", "source:é"):
        assert one(spark, S.stable_id(F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_truncation_keeps_characters_whole(spark):
    assert one(spark, S.truncate_text(F.lit("aéé"), 4)) == "aé"
    assert one(spark, S.truncate_text(F.lit("aéé"), 5)) == "aéé"


@pytest.mark.parametrize(
    ("base", "link", "wanted"),
    [
        ("http://h/a/b?x=1", "c", "http://h/a/c"),
        ("http://h/a/b", "../c#d", "http://h/c"),
        ("http://h", "c", "http://h/c"),
        ("https://h/a", "//o/x", "https://o/x"),
        ("http://h/a/b", "?q=2", "http://h/a/b?q=2"),
        ("http://h/a", "mailto:x@y", None),
        ("http://h/a", "HTTPS://O/z", "HTTPS://O/z"),
    ],
)
def test_links_resolve(spark, base, link, wanted):
    assert one(spark, S.resolve_url(F.lit(base), F.lit(link))) == wanted


def test_csv_fields(spark):
    fields = lambda line, d=",": one(spark, csv.split_fields(F.lit(line), d))
    assert fields('1,"a,b","c ""d""",') == ["1", "a,b", 'c "d"', ""]
    assert fields("a|b", "|") == ["a", "b"]
    with pytest.raises(ValueError):
        csv.Dialect(";;")


def test_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿n;Preço;x\r\n1;\"8.480,75\";true\r\n2; - ;false\r\n".encode())
    rows = csv.scan_csv(spark, str(tmp_path / "a.csv"), csv.Dialect(";"))
    assert rows.dtypes == [("n", "bigint"), ("Preço", "string"), ("x", "boolean")]
    assert [tuple(r) for r in rows.orderBy("n").collect()] == [(1, "8.480,75", True), (2, None, False)]
    (tmp_path / "b.csv").write_bytes("made\nNome,A\nJosé,1\nAna\n".encode("latin-1"))
    latin = csv.Dialect(preamble=1, encoding="ISO-8859-1")
    with pytest.raises(ValueError, match="width"):
        csv.scan_csv(spark, str(tmp_path / "b.csv"), latin)
    assert {tuple(r) for r in csv.scan_csv(spark, str(tmp_path / "b.csv"), latin, strict=False).collect()} == {("José", 1), ("Ana", None)}


def test_csv_profile_reads_all_lines(spark):
    late = F.when(F.col("id") == 26_000, '1,2,"3"').when(F.col("id") == 30_000, "1,2").otherwise("1,2,3")
    wider = F.when(F.col("id") <= 25_000, "a;b").otherwise("a;b;c")
    lines = [spark.range(1, 60_001).select(F.lit(f).alias("file"), F.col("id").alias("number"), line.alias("line")) for f, line in (("late", late), ("wider", wider))]
    got = {r["file"]: (r["delimiter"], r["width"], r["quoted"], r["preamble"], r["share"]) for r in csv.profile_csv(lines[0].union(lines[1])).collect()}
    assert got == {"late": (",", 3, True, 0, 59_999 / 60_000), "wider": (";", 3, False, 25_000, 35_000 / 60_000)}


def test_csv_profile_finds_headers_and_encoding(spark):
    texts = {"named": ["made by hand", "a;b", "1;2", "3;4"], "bare": ["1;2", "3;4"], "twice": ["a;a", "1;2"], "gap": ["a;", "1;2"], "latin": ["a;b", "1;Jos\ufffd"]}
    lines = spark.createDataFrame([(f, i, x) for f, xs in texts.items() for i, x in enumerate(xs, 1)], "file string, number long, line string")
    got = {r["file"]: (r["preamble"], r["header"], r["encoding"]) for r in csv.profile_csv(lines).collect()}
    assert got == {"named": (1, True, "UTF-8"), "bare": (0, False, "UTF-8"), "twice": (0, False, "UTF-8"), "gap": (0, False, "UTF-8"), "latin": (0, True, "windows-1252")}
    assert csv.profile_csv(lines.limit(0)).count() == 0


def test_json_documents(spark):
    bodies = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "file string, body string")
    rows = J.scan_json(bodies('[{"a":1,"b":null,"c":{"d":[1]}},{"a":"x","b":null}]', '{"a":true}'))
    assert dict(rows.dtypes)["a"] == "string" and dict(rows.dtypes)["b"] == "string"
    assert {r["a"] for r in rows.collect()} == {"1", "x", "true"}
    for bad in ('{"a":1}\n{"a":2}', "nothing"):
        with pytest.raises(Exception, match="no JSON document"):
            J.scan_json(bodies(bad)).collect()
    with pytest.raises(ValueError):
        J.scan_json(bodies("[]"))


def test_geojson(spark):
    feature = lambda p, g: {"type": "Feature", "properties": p, "geometry": g}
    body = lambda *fs: spark.createDataFrame([("f", json.dumps({"type": "FeatureCollection", "features": list(fs)}))], "file string, body string")
    rows = J.scan_geojson(body(feature({"n": 1}, {"type": "Point", "coordinates": [1, 2]}), feature(None, None))).collect()
    assert [(r["n"], r["geometry_type"]) for r in rows] == [(1, "Point"), (None, None)]
    with pytest.raises(ValueError):
        J.scan_geojson(body(feature({"geometry": 1}, None)))


def test_data_packages(spark):
    body = json.dumps({"name": "p", "resources": [{"name": "a", "path": ["x", "y"], "bytes": 7, "sources": [{"title": "s"}]}, {"name": "b"}]})
    df = lambda file, text: spark.createDataFrame([(file, text)], "file string, body string")
    rows = J.scan_datapackage(df("/x/datapackage.json", body), "p1").collect()
    assert [(r["name"], r["path"], r["bytes"], r["package_id"]) for r in rows] == [("a", '["x","y"]', 7, "p1"), ("b", None, None, "p1")]
    for file, text in (("/x/other.json", body), ("datapackage.json", "{}")):
        with pytest.raises(Exception, match="datapackage|resources"):
            J.scan_datapackage(df(file, text), "p1").collect()


def test_drive_links(spark):
    hrefs = ["https://drive.google.com/drive/u/1/folders/A_-1?resourcekey=k", "https://drive.google.com/file/d/b!d/view", "https://drive.google.com/uc?export=x&amp;id=c%20c", "https://docs.google.com/file/d/e", "https://drive.google.com/open?id=", "https://drive.google.com/about"]
    page = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    got = {tuple(r)[1:] for r in pages.extract_drive_links(spark.createDataFrame([("http://h/", page), ("http://h/2", None)], "url string, html string")).collect()}
    assert got == {("folder", "A_-1", "k"), ("file", "c c", None), ("file", "", None)}


def test_first_sync_result_counts(spark):
    syncs = spark.createDataFrame([(1, 9, "running", 0), (2, 9, "running", 0), (3, 9, "running", 0)], "id long, instance_id long, status string, count int")
    results = spark.createDataFrame([(1, True, None, 5, 2), (1, False, "late", 0, 3), (2, True, None, 4, 1), (2, False, "e", 0, 1), (3, None, None, 1, 1)], "sync_id long, success boolean, error string, count int, ts int")
    got = {r["id"]: (r["status"], r["count"], r["error"]) for r in ledger.apply_sync_results(syncs, results).collect()}
    assert got == {1: ("completed", 5, None), 2: ("failed", 0, "e"), 3: ("running", 0, None)}


def test_crawl_is_bounded(spark):
    df = spark.createDataFrame([(f"http://h/{i}", f'<a href="{i + 1}">') for i in range(9)], "url string, html string")
    assert pages.crawl_frontier(df, df.limit(1)).count() == 5
    with pytest.raises(ValueError):
        pages.crawl_frontier(df, df.limit(1), most=3)


def test_crawl_stays_below_its_root(spark):
    html = '<a href="/data/b/"> <a href="/else/"> <a href="//other/data/"> <a href="http://other/data/"> <a href="/data/c.html">'
    urls = ["http://h/data/", "http://h/data/b/", "http://h/else/", "http://other/data/", "http://h/data/c.html"]
    df = spark.createDataFrame([(u, html) for u in urls], "url string, html string")
    walk = lambda *roots: sorted(map(tuple, pages.crawl_frontier(df, df.filter(F.col("url").isin(*roots))).collect()))
    assert walk("http://h/data/") == [("http://h/data/", 0), ("http://h/data/b/", 1)]
    assert walk("http://h/data/", "http://h/data/b/", "http://other/data/") == [("http://h/data/", 0), ("http://h/data/b/", 0), ("http://other/data/", 0)]


def test_alerts_keep_periods_and_what_they_affect(spark):
    alert = {"active_period": [{"start": 5, "end": 9}, {"start": 11}], "informed_entity": [{"agency_id": "a", "route_type": 3, "trip": {"trip_id": "t"}}, {"stop_id": "s"}], "severity_level": 4}
    place = {"occupancy_status": 2, "occupancy_percentage": 40}
    content = fixtures.encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [{"id": "1", "alert": alert, "vehicle": place}]}, transit.FEED)
    row = transit.scan_gtfs_rt(spark.createDataFrame([("f", bytearray(content))], "file string, content binary")).first()
    assert [tuple(p) for p in row["alert"]["active_period"]] == [(5, 9), (11, None)]
    assert [(e["agency_id"], e["route_type"], e["trip"] and e["trip"]["trip_id"], e["stop_id"]) for e in row["alert"]["informed_entity"]] == [("a", 3, "t", None), (None, None, None, "s")]
    assert row["alert"]["severity_level"] == 4 and row["vehicle"]["occupancy_status"] == 2 and row["vehicle"]["occupancy_percentage"] == 40


def test_trees_with_cycles_are_errors(spark):
    rows = spark.createDataFrame([("s", "a", "b", "A"), ("s", "b", "a", "B"), ("s", "c", "x", "C"), ("s", "d", None, "D")], "source_id string, id string, parent_id string, title string")
    assert {(r["id"], r["problem"]) for r in catalogue.validate_tree(rows, 8).collect()} == {("a", "cycle"), ("b", "cycle"), ("c", "missing parent")}
    with pytest.raises(Exception, match="cycle"):
        catalogue.resource_paths(rows.filter("id <> 'c'"), depth=8).collect()


def test_state_tables_keep_versions(spark, tmp_path):
    table = StateTable(spark, f"file://{tmp_path}/t", "k int, v string")
    assert table.read().count() == 0
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    table.update(lambda old: ledger.upsert(old, rows((1, "a"), (2, "b")), ["k"]), once=("w", 3))
    table.update(lambda old: ledger.upsert(old, rows((1, "z")), ["k"]), once=("w", 3))
    table.update(lambda old: ledger.upsert(old, rows((2, "c"), (3, "d")), ["k"]))
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, table.read(1).collect())) == [(1, "a"), (2, "b")]


def test_geo_files_tell_kinds_and_bounds_in_their_footers(spark, tmp_path):
    import pyarrow.parquet as pq

    shapes = {
        "a": {"type": "Point", "coordinates": [1, 2]},
        "b": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, -5.5], [0, 0]]]},
        "c": {"type": "GeometryCollection", "geometries": [{"type": "MultiPoint", "coordinates": [[9, 9], [8, 8]]}, {"type": "LineString", "coordinates": [[1, 1], [2, 2]]}]},
        "d": {"type": "Point", "coordinates": [1, 2, 3]},
        "e": {"type": "Point", "coordinates": []},
    }
    geo = {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": {"edges": "planar"}}}
    df = spark.createDataFrame([*((k, json.dumps(v)) for k, v in shapes.items()), ("f", None)], "id string, geometry string").coalesce(1)
    path = K.write_geo_table(df, f"file://{tmp_path}", "r", "v1", geo)
    (file,) = (tmp_path / "r" / "ducklake_v1.parquet").glob("*.parquet")
    held = json.loads(pq.read_metadata(file).metadata[b"geo"])
    assert held["columns"]["geometry"] == {"encoding": "WKB", "edges": "planar", "geometry_types": ["GeometryCollection", "Point", "Polygon"], "bbox": [0, -5.5, 9, 9]}
    assert json.loads(spark.read.text(f"file://{tmp_path}/r/geo_v1").first()[0]) == held
    binary = {r["id"]: None if r["geometry"] is None else bytes(r["geometry"]) for r in spark.read.parquet(path).collect()}
    double = lambda *xs: struct.pack(f"<{len(xs)}d", *xs)
    head = lambda code, *ns: b"\x01" + b"".join(n.to_bytes(4, "little") for n in (code, *ns))
    assert binary["a"] == head(1) + double(1, 2) and binary["d"] == head(1001) + double(1, 2, 3) and binary["f"] is None
    assert binary["b"] == head(3, 1, 4) + double(0, 0, 4, 0, 4, -5.5, 0, 0) and len(binary["e"]) == 21
    assert binary["c"] == head(7, 2) + head(4, 2) + head(1) + double(9, 9) + head(1) + double(8, 8) + head(2, 2) + double(1, 1, 2, 2)


def test_footers_of_nested_and_empty_files(spark, tmp_path):
    df = spark.createDataFrame([(1, [{"x": None}, {"x": 2}], {"k": [1.5]}), (None, None, None)], "a int, b array<struct<x:int>>, c map<string,array<double>>").coalesce(1)
    K.write_files(df, str(tmp_path / "t"), {"k": "é"})
    row = statistics.file_footers(spark, str(tmp_path / "t")).first()
    assert row["n_rows"] == 2 and row["metadata"]["k"] == "é"
    assert {(c["path"], c["field_id"]) for c in row["columns"]} == {("a", 1), ("b.list.element.x", 4), ("c.key_value.key", 7), ("c.key_value.value.list.element", 9)}
    assert {c["path"]: c["null_count"] for c in row["columns"]}["a"] == 1
    K.write_files(df.limit(0), str(tmp_path / "e"))
    assert [r["n_rows"] for r in statistics.file_footers(spark, str(tmp_path / "e")).collect()] == [0]
    for _ in range(2):  # again, as when a task is lost
        K.write_files(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_a_snapshot_is_one_file_of_the_first_writer(spark, tmp_path):
    header = {"source_id": "7", "sync_id": "s", "collected_at": "2024-01-01T00:00:00Z", "resources_total": 100}
    rows = spark.range(100_000).repartition(8)
    assert K.write_snapshot(header, rows, str(tmp_path)) and not K.write_snapshot(header, rows.limit(1), str(tmp_path))
    lines = (tmp_path / "7" / "s.jsonl").read_text().splitlines()
    assert json.loads(lines[0])["version"] == 1 and sorted(json.loads(x)["id"] for x in lines[1:]) == list(range(100_000))
    assert [p.name for p in (tmp_path / "7").iterdir()] == ["s.jsonl"]


def test_of_two_writers_one_gets_the_name(spark, tmp_path):
    (tmp_path / "a").write_text("first")
    (tmp_path / "b").write_text("second")
    target = str(tmp_path / "x")
    assert folders.publish_file(spark, str(tmp_path / "a"), target) and not folders.publish_file(spark, f"file://{tmp_path}/b", target)
    assert (tmp_path / "x").read_text() == "first" and sorted(p.name for p in tmp_path.iterdir()) == ["x"]


def test_messages_replayed_change_nothing(spark):
    rows = [(i, datetime.datetime(2024, 1, 1, 0, i), 1, "j", s) for i, s in enumerate(["SUCCESS", "PENDING", "PROCESSING", "FAILED", "SUCCESS", "PROCESSING", "SUCCESS"])]
    df = spark.createDataFrame(rows, "event_id int, ts timestamp, resource_id int, job_id string, status string")
    assert [r["event_id"] for r in ledger.fold_job_results(df).orderBy("ts").collect()] == [3, 6]
    assert [r["event_id"] for r in ledger.fold_job_results(df.union(df)).orderBy("ts").collect()] == [3, 6]
    assert ledger.job_states(df).first()["status"] == "completed"


def test_csv_records_over_several_lines_and_wide_ones(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"long\nname",note\n1,"two\nlines","a ""b"" c"\n2,one,"x\n\ny"\n')
    rows = csv.scan_csv(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["id", "long\nname", "note"] and rows.dtypes[0] == ("id", "bigint")
    assert sorted(map(tuple, rows.collect())) == [(1, "two\nlines", 'a "b" c'), (2, "one", "x\n\ny")]
    width = 2500
    lines = [",".join(f'"c,{i}"' for i in range(width)), ",".join(f'"{i}"' for i in range(width))]
    (tmp_path / "b.csv").write_text("\n".join(lines))
    line = spark.read.text(str(tmp_path / "b.csv")).select(F.transform(csv.split_fields(F.col("value"), ","), lambda x: x).alias("f"))
    assert {len(r["f"]) for r in line.collect()} == {width}
    wide = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(50_000)), lambda i: F.concat(F.lit('"'), i.cast("string"), F.lit(',"'))), ",").alias("line"))
    fields = wide.select(csv.split_fields(F.col("line"), ",").alias("f")).first()["f"]
    assert len(fields) == 50_000 and fields[0] == "1," and fields[-1] == "50000,"
    assert [k.simpleString() for k in csv.infer_field_types(spark.createDataFrame([(["1", "x", None, "true"],), (["-2", "3", "-", "FALSE"],)], "fields array<string>"), 4)] == ["bigint", "string", "string", "boolean"]


def test_an_open_quote_that_nothing_closes_ends_with_its_line(spark):
    lines = spark.createDataFrame([("f", 1, 'a,"b'), ("f", 2, 'c"'), ("f", 3, 'd,"e'), ("f", 4, "g")], "file string, number long, line string")
    assert sorted((r["number"], r["line"]) for r in csv.join_records(lines).collect()) == [(1, 'a,"b\nc"'), (3, 'd,"e'), (4, "g")]


def test_eight_readers_scan_the_source_twice(spark):
    rows = spark.range(40).select("id", F.lit("x").alias("format"))
    reader = lambda k: routing.Reader(f"r{k}", F.lit(True), lambda df: df.select("id", F.when(F.col("id") % 8 == k, 1).otherwise(0).alias("rows"), F.lit(None).cast("string").alias("error")))
    out = routing.ingest_resources(rows, [reader(k) for k in range(8)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") <= 2
    assert {r["id"]: r["reader"] for r in out.collect()} == {i: f"r{i % 8}" for i in range(40)}


def test_unknown_fields_of_packages_and_resources_are_refused(spark):
    page = lambda body: spark.createDataFrame([(0, body)], "start long, body string")
    good = '[{"id":"a","author":"x","license_id":"l","tags":[{"name":"t","state":"active"}],"resources":[{"id":"r","mimetype":"m","position":3}]}]'
    packages, resources = J.scan_packages(page(good), "http://p")
    assert packages.select("author", "license_id").first() == ("x", "l") and resources.select("id", "package_id", "position", "mimetype").first() == ("r", "a", 3, "m")
    for bad in ('[{"id":"a","odd":1}]', '[{"id":"a","resources":[{"id":"r","odd":1}]}]'):
        with pytest.raises(Exception, match="unknown fields"):
            [df.collect() for df in J.scan_packages(page(bad), "http://p")]


def test_links_with_blanks_and_without_quotes(spark):
    df = spark.createDataFrame([("http://h/d/", """<a href="my file.csv">x</a><A class=q HREF=' b.zip '>y</A><a href=c.html>z</a><a href="">e</a>""")], "url string, html string")
    assert {r["target"] for r in pages.extract_links(df).collect()} == {"http://h/d/my%20file.csv", "http://h/d/b.zip", "http://h/d/c.html"}


def test_only_the_latest_job_changes_its_resource(spark):
    rows = spark.createDataFrame([(1, "b", "pending", 0), (2, "c", "pending", 0)], "resource_id long, latest_job_id string, status string, updated_at long")
    changes = spark.createDataFrame([(1, "a", "FAILED", 9, 9), (1, "b", "PROCESSING", 5, 5), (1, "b", "SUCCESS", 6, 6), (3, "d", "SUCCESS", 1, 1)], "resource_id long, job_id string, status string, ts long, event_id long")
    assert sorted((r["resource_id"], r["status"], r["updated_at"]) for r in ledger.guarded_latest(rows, changes).collect()) == [(1, "SUCCESS", 6), (2, "pending", 0)]


def test_sync_errors_are_joined_without_a_hash_table(spark):
    """Alike errors are small on disk and very large in a broadcast table."""
    syncs = spark.range(9).selectExpr("id", "id AS instance_id", "'running' AS status", "0 AS count")
    results = spark.range(9).selectExpr("id AS sync_id", "id % 2 = 0 AS success", "repeat('e', 20000) AS error", "7 AS count")
    df = ledger.apply_sync_results(syncs, results)
    assert {r["id"]: len(r["error"] or "") for r in df.collect()} == {i: 16000 * (i % 2) for i in range(9)}
    assert "Broadcast" not in df._jdf.queryExecution().toString()


def test_feeds_of_few_entities_share_batches():
    import pyarrow as pa

    from lakewright.queries import fixtures
    from lakewright.sources import transit

    encode = fixtures.encoder(transit.FEED)
    feed = lambda *ids: encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [{"id": i, "stop": {"stop_lat": 0.5}} for i in ids]})
    long = [f"l{i}" for i in range(3 * transit.BATCH_ENTITIES)]
    contents = [feed(str(i)) for i in range(5000)] + [feed(), feed(*long)]
    batches = list(transit.entity_batches([pa.RecordBatch.from_pydict({"file": ["f"] * len(contents), "content": contents})]))
    assert [b["id"][0].as_py() for b in batches[:2]] == ["0", "4096"] and max(b.num_rows for b in batches) == transit.BATCH_ENTITIES and len(batches) == 5
    assert [i for b in batches for i in b["id"].to_pylist()] == [str(i) for i in range(5000)] + long


def test_an_export_can_be_whole(spark, tmp_path):
    K.export(spark.range(10_050), "csv", str(tmp_path / "all"), limit=None)
    K.export(spark.range(10_050), "csv", str(tmp_path / "bound"))
    assert [spark.read.option("header", True).csv(str(tmp_path / n)).count() for n in ("all", "bound")] == [10_050, 10_000]


def test_lines_of_documents_are_numbered_where_they_are(spark, monkeypatch):
    from lakewright import catalog
    from lakewright.queries import sources
    from tests.conftest import SMALL

    seen = []
    monkeypatch.setattr(sources, "number_lines", lambda lines: seen.append(lines) or lines.select("file", "line", F.lit(1).alias("number")))
    catalog.QUERIES["s11_ordered_lines"](spark, SMALL)
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_tables_without_resource_or_dataset_are_not_dealt_together(spark):
    tables = spark.createDataFrame([("a", 1), ("b", 2), ("c", 9), ("d", None), ("e", 3)], "table_name string, resource_id long")
    resources = spark.createDataFrame([(1, "R", "x", 5), (2, None, None, 5), (3, None, "y", None), (None, "N", "n", 5)], "id long, title string, description string, dataset_id long")
    datasets = spark.createDataFrame([(5, "D", "z"), (None, "no", "no")], "id long, title string, description string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = catalogue.enrich_legacy(tables, resources, datasets)
        assert sorted(map(tuple, df.collect()), key=str) == sorted([("a", "R", "x", "D"), ("b", "D", "z", "D"), ("c", "c", "", None), ("d", "d", "", None), ("e", "e", "y", None)], key=str)
        # the datasets, which many tables lack, are joined to resources, not to tables
        joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
        assert ["resource_id" in line for line in joins] == [True, False]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_captures_go_out_in_bounded_batches():
    import pandas as pd

    rows = pd.DataFrame({"key": [str(i) for i in range(40)], "url": "u", "html": ["x" * 1_000_000] * 39 + [None]})
    got = list(K.capture_batches([rows, rows.iloc[:0]], "d"))
    assert [k for df in got for k in df["key"]] == list(rows["key"]) and max(map(len, got)) == 9
