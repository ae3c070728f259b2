"""Archives: round trips, and damage that must be found."""

import hashlib

import pytest

from lakewright.llm import common, warc

SCHEMA = "page_id long, url string, html string, payload string"


def test_round_trip(spark):
    long = "<p>" + "é" * 60 + "</p>"
    rows = [(5, "http://a/ü x", long), (3, "http://b/", long), (9, None, long), (1, "http://c/", "short"), (2, "http://d/", "short"), (7, "http://e/", None), (8, "http://f/\r\nX: y", ""), (None, "u", long), (3, "http://b/", long)]
    rows += [(100 + i, "http://many/", f"<p>page {i} " + "word " * 300) for i in range(60)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    files = warc.write_archives(pages, common.shared_folder(spark, "warc"), file_bytes=4000)
    assert files.count() > 1
    found = sorted((r.asDict() for r in warc.read_archives(files).collect()), key=str)
    wanted = []
    for page_id, _, text in rows:
        raw = (text or "").encode()
        head = 3 if text == long else None
        first = head if head is not None and page_id not in (head, None) else None
        wanted.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "response" if first is None else "revisit", first, raw if first is None else None))
    assert sorted(wanted, key=str) == sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]) if r["payload"] is not None else None) for r in found), key=str)


def test_dictionary_frame_comes_first_and_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://x/", "text " * i, None) for i in range(40)], SCHEMA)
    files = warc.write_archives(pages.coalesce(1), f"file://{tmp_path}/w")
    path = files.first()["path"][7:]
    data = open(path, "rb").read()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    for wrong in (data[:-5], data[: len(data) // 2], data[:6]):
        with open(path, "wb") as f:
            f.write(wrong)
        with pytest.raises(Exception, match="cut short|records|frame|decompress"):
            warc.read_archives(files).collect()


def test_a_very_long_page(spark):
    long = "<p>long \u00e9 page</p>" * 1_000_000
    rows = [(1, "http://a/", long, "x"), (2, "http://a/", long, "x"), (3, None, None, None)]
    found = {r["page_id"]: r for r in warc.archived(spark.createDataFrame(rows, SCHEMA)).collect()}
    raw = long.encode()
    assert [(found[i]["payload_bytes"], found[i]["payload_digest"], found[i]["record_type"], found[i]["refers_to"]) for i in (1, 2)] == [(len(raw), hashlib.sha256(raw).hexdigest(), "response", None), (len(raw), hashlib.sha256(raw).hexdigest(), "revisit", 1)]
    assert found[3]["payload_bytes"] == 0


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("change", [(b"Content-Length: 6", b"Content-Length: 7"), (b"WARC-Date", b"WARC-Day"), (b"hello", b"jello"), (b"WARC/1.1", b"WORK/1.1")])
def test_headers_are_checked(change):
    whole = warc.record(1, "http://a/", b"hello", hashlib.sha256(b"hello").hexdigest(), None, "2024-01-01T00:00:00Z")
    assert warc.parse(whole)["payload"] == b"hello"
    if change[0] in whole:
        with pytest.raises(ValueError):
            warc.parse(whole.replace(*change))
