"""Readers behind the router: odd bodies, fallbacks, tables of very different resources, tasks that run twice."""

import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakewright.queries import fixtures
from lakewright.sources import readers as R
from lakewright.sources import transit

RESOURCES = "id string, format string, url string, file_name string, datastore_active boolean, note string"
CAPTURES = "id string, start long, page_url string, status int, content binary"


def ingest(spark, tmp_path, items):
    """items: id -> (format, file name, active, [(status, body), ...])."""
    resources = spark.createDataFrame([(k, f, f"http://h/d/{k}.html", name, active, "x") for k, (f, name, active, _) in items.items()], RESOURCES)
    bodies = [(k, i, f"http://h/d/{k}.html", status, b if b is None or isinstance(b, bytes) else b.encode()) for k, item in items.items() for i, (status, b) in enumerate(item[3])]
    outcomes, files = R.ingest_tables(resources, spark.createDataFrame(bodies, CAPTURES), str(tmp_path), "v")
    return {r["resource_id"]: r for r in outcomes.collect()}, {r["id"]: r for r in files.collect()}


def test_readers_in_turn_and_a_table_for_each(spark, tmp_path):
    feed = fixtures.encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [{"id": "1"}]}, transit.FEED)
    html = '<a href="a.csv">a</a><a href="/x/b.ZIP">b</a><a href="https://drive.google.com/drive/folders/f1">d</a><a href="page/">p</a><a href="a.csv#x">again</a>'
    items = {
        "quotes": ("csv", "f", False, [(200, 'id,name\n1,5" pipe\n2,"two\nlines"\n\n3,-\n')]),
        "semicolons": ("CSV", "f", False, [(200, "made by hand\na;A;b\n1;2,5;true\n2;3,5;FALSE\n".encode("latin-1"))]),
        "ragged": ("csv,json", "f", False, [(200, "a,b\n1,2\n1,2\n1,2,3\n")]),
        "package": ("JSON", "datapackage.json", False, [(200, '{"resources":[]}')]),
        "plain": ("JSON", "datapackage.json", False, [(200, '[{"b":1,"a":{"x":[1,null]},"c":null,"é `q`":true},{"b":2.5,"m":1},{"m":"t"}]')]),
        "broken": ("json", "f", False, [(200, '[{"a":1}')]),
        "scalars": ("json", "f", False, [(200, "[1,2]")]),
        "shapes": ("geojson", "f", False, [(200, '{"type":"FeatureCollection","features":[{"properties":{},"geometry":{"type":"Point","coordinates":[1,2]}},{"properties":{"n":1},"geometry":null}]}')]),
        "clash": ("geojson", "f", False, [(200, '{"type":"FeatureCollection","features":[{"properties":{"geometry":1},"geometry":null}]}')]),
        "store": ("csv", "f", True, [(200, '{"fields":[{"id":"_id"},{"id":"v"}],"records":[[1,null],[2]]}'), (200, '{"fields":[],"records":[]}'), (200, '{"fields":[{"id":"_id"}],"records":[[3]]}')]),
        "nostore": ("csv", "f", True, [(200, "a,b\n1,2\n")]),
        "feed": ("gtfs-rt", "f", False, [(200, feed)]),
        "cut": ("pb", "f", False, [(200, feed[:-1])]),
        "log": ("log", "f", False, [(200, "1\r\n\n<EV=2>\n")]),
        "pdf": ("pdf", "my.pdf", False, []),
        "gone": ("csv,json", "f", False, [(404, "x")]),
        "down": ("csv", "f", False, [(500, "x")]),
        "links": ("zip", "f", False, [(200, html)]),
        "zip": ("zip", "f", False, [(200, fixtures.zipped({"a.csv": "1", "b/c.csv": "22"}))]),
        "badzip": ("zip", "f", False, [(200, b"PKnothing")]),
        "odd": ("xls", "f", False, [(200, "x")]),
        "none": ("csv", "f", False, [(200, None)]),
    }
    outcomes, files = ingest(spark, tmp_path, items)
    assert {k: (r["status"], r["reader"], r["rows_processed"], r["columns"]) for k, r in outcomes.items() if r["status"] == "SUCCESS"} == {
        "quotes": ("SUCCESS", "csv", 3, 2), "semicolons": ("SUCCESS", "csv", 2, 3), "plain": ("SUCCESS", "json", 3, 5), "shapes": ("SUCCESS", "json", 2, 3), "store": ("SUCCESS", "datastore", 2, 2),
        "nostore": ("SUCCESS", "csv", 1, 2), "package": ("SUCCESS", "json", 1, 1), "feed": ("SUCCESS", "protobuf", 1, 1), "log": ("SUCCESS", "log", 3, 2), "pdf": ("SUCCESS", "file_reference", 1, 2), "links": ("SUCCESS", "crawler", 3, 3), "zip": ("SUCCESS", "crawler", 2, 3),
    }
    assert {k: (r["status"], r["error_message"]) for k, r in outcomes.items() if r["status"] != "SUCCESS"} == {
        "ragged": ("FAILED", "csv: line 4: 3 fields for 2; json: no JSON document"),
        "broken": ("FAILED", "json: no JSON document"), "scalars": ("FAILED", "json: a row is no object"), "clash": ("FAILED", "json: a property is named geometry"),
        "cut": ("FAILED", "protobuf: no feed: the feed is cut short"), "gone": ("DELETED", "csv: HTTP 404"), "down": ("FAILED", "csv: HTTP 500"),
        "badzip": ("FAILED", "crawler: no archive: File is not a zip file"), "odd": ("FAILED", "unsupported"), "none": ("FAILED", "csv: no rows"),
    }
    table = lambda k: pq.read_table(tmp_path / k / "ducklake_v.parquet")
    assert table("quotes").to_pylist() == [{"id": 1, "name": '5" pipe'}, {"id": 2, "name": "two\nlines"}, {"id": 3, "name": None}]
    assert table("semicolons").to_pylist() == [{"a": 1, "A__2": "2,5", "b": True}, {"a": 2, "A__2": "3,5", "b": False}]
    assert table("plain").to_pylist() == [{"a": {"x": [1, None]}, "b": 1.0, "c": None, "m": None, "é `q`": True}, {"a": None, "b": 2.5, "c": None, "m": "1", "é `q`": None}, {"a": None, "b": None, "c": None, "m": "t", "é `q`": None}]
    assert table("shapes").to_pylist() == [{"geometry": '{"type":"Point","coordinates":[1,2]}', "geometry_type": "Point", "n": None}, {"geometry": None, "geometry_type": None, "n": 1}]
    assert table("store").to_pylist() == [{"_id": "1", "v": ""}, {"_id": "2", "v": ""}]
    assert table("log").to_pylist() == [{"message": m, "order": i} for i, m in ((1, "1"), (2, ""), (3, "<EV=2>"))]
    assert table("pdf").to_pylist() == [{"name": "pdf.html", "url": "http://h/d/pdf.html"}]
    assert {(r["kind"], r["target"]) for r in table("links").to_pylist()} == {("file", "http://h/d/a.csv"), ("archive", "http://h/x/b.ZIP"), ("drive folder", "https://drive.google.com/drive/folders/f1")}
    assert [r["bytes"] for r in table("zip").to_pylist()] == [1, 2]
    assert set(files) == {k for k, r in outcomes.items() if r["status"] == "SUCCESS"}


def test_a_large_resource_is_dealt_over_files(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select(F.lit("big").alias("id"), F.col("id").alias("row"), F.to_json(F.struct("id")).alias("object"))
    monkeypatch.setattr(R, "FILE_ROWS", 100)
    layouts = R._layouts(rows, False)
    for _ in range(2):  # a task that runs again puts the same rows under the same name
        done = R.write_tables(rows, layouts, str(tmp_path), "v").collect()
        assert sorted(r["rows"] for r in done) == [100] * 10
    table = pq.read_table(tmp_path / "big" / "ducklake_v.parquet")
    assert sorted(table["id"].to_pylist()) == list(range(1000))
    assert not list((tmp_path / "big" / "ducklake_v.parquet").glob(".*"))


@pytest.mark.parametrize("layout, wanted", [("OBJECT<>", []), ("OBJECT<a: VOID>", ["string"]), ("OBJECT<`a<b>, c: d`: ARRAY<OBJECT<x: DECIMAL(2,1)>>>", ["list<item: struct<x: double>>"]), ("ARRAY<BIGINT>", [])])
def test_layouts(layout, wanted):
    assert [str(k).replace("element:", "item:") for _, k in R.arrow_fields(layout)] == wanted


def test_no_resources(spark, tmp_path):
    outcomes, files = R.ingest_tables(spark.createDataFrame([], RESOURCES), spark.createDataFrame([], CAPTURES), str(tmp_path), "v")
    assert outcomes.collect() == [] and files.collect() == []


def test_captures_are_read_once_for_all_readers(spark, tmp_path):
    def seen(frames):
        (tmp_path / uuid.uuid4().hex).touch()
        yield from frames

    resources = spark.createDataFrame([("1", "csv,json", "http://h/1", "x", False, "x"), ("2", "json", "http://h/2", "x", False, "x")], RESOURCES)
    captures = spark.createDataFrame([("1", 0, "p", 200, b'[{"a":1}]'), ("2", 0, "p", 200, b'[{"a":2},{"a":3}]')], CAPTURES).coalesce(1).mapInPandas(seen, CAPTURES)
    outcomes, _ = R.ingest_tables(resources, captures, str(tmp_path / "tables"), "v")
    assert {r["resource_id"]: (r["status"], r["rows_processed"]) for r in outcomes.collect()} == {"1": ("SUCCESS", 1), "2": ("SUCCESS", 2)}
    assert len([p for p in tmp_path.iterdir() if p.is_file()]) == 1
