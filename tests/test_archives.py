"""Archives by member: inner archives, limits, damage, large and long archives."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lakewright.sources import archives


def zipped(members, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def expanded(spark, folder, wanted="CSV", limits=archives.Limits()):
    prefix = len(f"file:{folder}/")
    return {r["label"][prefix:]: bytes(r["content"]) for r in archives.expand_archives(archives.read_archives(spark, str(folder)), wanted, limits).collect()}


def test_inner_archives_and_limits(spark, tmp_path):
    inner = zipped({"deep.csv": b"1", "x.txt": b"2", "in.ZIP": zipped({"é/deepest.CSV": b"3" * 10_000}, zipfile.ZIP_STORED)})
    (tmp_path / "a.zip").write_bytes(zipped({"d/top.csv": b"0", "in.zip": inner, "d/": b""}))
    (tmp_path / "b.zip").write_bytes(b"junk before" + zipped({"top.csv": b"b" * 3_000_000, "a.geojson": b"{}"}))
    assert expanded(spark, tmp_path) == {"a.zip!/d/top.csv": b"0", "a.zip!/in.zip!/deep.csv": b"1", "a.zip!/in.zip!/in.ZIP!/é/deepest.CSV": b"3" * 10_000, "b.zip!/top.csv": b"b" * 3_000_000}
    assert expanded(spark, tmp_path, "JSON") == {"b.zip!/a.geojson": b"{}"}
    for limits, message in ((archives.Limits(depth=2), "nested"), (archives.Limits(entries=5), "too many"), (archives.Limits(expanded_bytes=3_000_000), "too many"), (archives.Limits(archive_bytes=200), "too large")):
        with pytest.raises(Exception, match=message):
            expanded(spark, tmp_path, limits=limits)


def test_members_are_held_to_sizes_and_checksums(spark, tmp_path):
    good = zipped({"a.csv": b"x" * 500})
    at = good.index(b"PK\x01\x02")
    for field, value in ((24, 7), (24, 600), (16, 1), (20, 3)):  # size, checksum and packed size in the directory
        data = bytearray(good)
        data[at + field : at + field + 4] = value.to_bytes(4, "little")
        (tmp_path / "a.zip").write_bytes(data)
        with pytest.raises(Exception, match="another size|cut short|incomplete"):
            expanded(spark, tmp_path)
        assert expanded(spark, tmp_path, "JSON") == {}  # not unpacked at all
    (tmp_path / "a.zip").write_bytes(good[:-10])
    with pytest.raises(Exception, match="not a zip file"):
        expanded(spark, tmp_path)


def test_an_archive_above_two_gibibytes(spark, tmp_path):
    """The directory and the wanted members are read by ranges; a whole file of this size fits in no cell."""
    path = tmp_path / "big.zip"
    with open(path, "wb") as out:
        out.truncate((9 << 28) + 5)  # a hole, as if of members that nobody wants
        out.seek(0, os.SEEK_END)
        out.write(zipped({"a.csv": b"1,2\n", "b.bin": b"\x00" * 1000, "c.csv": b"3,4\n" * 1000}))
    assert path.stat().st_size > 1 << 31
    assert expanded(spark, tmp_path) == {"big.zip!/a.csv": b"1,2\n", "big.zip!/c.csv": b"3,4\n" * 1000}


def test_a_hundred_thousand_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as z:
        for i in range(100_000):
            z.writestr(zipfile.ZipInfo(f"{i}.csv"), str(i))
    rows = archives.expand_archives(archives.read_archives(spark, str(tmp_path)), "CSV")
    number = F.regexp_extract("name", "([0-9]+)", 1).cast("long")
    assert rows.select(F.count("*"), F.sum(number), F.count_if(F.decode("content", "UTF-8").cast("long") == number)).first() == (100_000, sum(range(100_000)), 100_000)
    with pytest.raises(Exception, match="too many"):
        archives.expand_archives(archives.read_archives(spark, str(tmp_path)), "CSV", archives.Limits(entries=99_999))


def test_no_archives(spark, tmp_path):
    assert archives.expand_archives(spark.createDataFrame([], "file string, length long"), "CSV").collect() == []
