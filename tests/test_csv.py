"""CSV records against a walk over characters; preambles, wide files."""

import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.sources import csv


def walked(text, delimiter=",", quote='"'):
    """(first line's number, fields or None if open at the end) of each record, a character at a time."""
    records, fields, field, state, number, first, i = [], [], "", "start", 1, 1, 0
    while i <= len(text):
        c = text[i] if i < len(text) else "\n"
        end = i == len(text)
        if state == "quoted" and not end:
            if c == quote and text[i + 1 : i + 2] == quote:
                field, i = field + quote, i + 1
            elif c == quote:
                state = "after"
            else:
                field += c
                number += c == "\n"
        elif state == "start" and c == quote and not end:
            state = "quoted"
        elif c == delimiter and not end:
            fields, field, state = [*fields, field], "", "start"
        elif c == "\n":
            if (not end or state == "quoted" or text[-1:] != "\n") and (fields or field or state != "start"):
                records.append((first, None if state == "quoted" else [*fields, field]))
            number += 1
            fields, field, state, first = [], "", "start", number
        else:
            field, state = field + c, state if state == "after" else "plain"
        i += 1
    return records


def lines_of(spark, files):
    rows = [(f, n, line) for f, text in files.items() for n, line in enumerate(text.removesuffix("\n").split("\n"), 1)]
    return spark.createDataFrame(rows, "file string, number long, line string")


def framed(spark, files, dialect=csv.Dialect()):
    out = {f: [] for f in files}
    for r in csv.join_records(lines_of(spark, files), dialect).select("file", "number", csv.split_fields(F.col("line"), dialect.delimiter, dialect.quote).alias("fields")).collect():
        out[r["file"]].append((r["number"], r["fields"]))
    return {f: sorted(rows) for f, rows in out.items()}


def test_stray_quotes_lose_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,n\n1,5" pipe,3\n2,x,4\n3,6" pipe,5\n4,y,6\n5,"a"b "c",7\n6,"d, ""e""" ,8\n')
    rows = csv.scan_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(map(tuple, rows.collect())) == [(1, '5" pipe', 3), (2, "x", 4), (3, '6" pipe', 5), (4, "y", 6), (5, 'ab "c"', 7), (6, 'd, "e" ', 8)]


def test_quotes_in_a_preamble_open_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"report "A\n"made, by\nid,name\n1,"x\ny"\n2,z\n')
    rows = csv.scan_csv(spark, str(tmp_path / "a.csv"), csv.Dialect(preamble=2))
    assert sorted(map(tuple, rows.collect())) == [(1, "x\ny"), (2, "z")]


def test_line_ends_inside_quotes_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,"long\r\nname"\r\n1,"two\nlines"\r\n2,"a\r\n\r\nb"\r\n')
    rows = csv.scan_csv(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["id", "long\r\nname"]
    assert sorted(map(tuple, rows.collect())) == [(1, "two\nlines"), (2, "a\r\n\r\nb")]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 16])
def test_records_against_a_walk(spark, monkeypatch, block):
    monkeypatch.setattr(csv, "BLOCK", block)
    rng = random.Random(block)
    files = {f"f{i}": "".join(rng.choices(['"', '""', ",", "\n", "a", ' "', ',"', '"\n'], [5, 2, 6, 5, 6, 1, 5, 3], k=rng.randrange(1, 60))) for i in range(120)}
    for f, text in list(files.items()):
        while (records := walked(text)) and records[-1][1] is None:  # open at the end: close it
            text += '"'
        files[f] = text
    files = {f: t for f, t in files.items() if t.strip("\n")}
    assert framed(spark, files) == {f: walked(t) for f, t in files.items()}


def test_other_delimiters_and_quotes(spark):
    for d, q in ((";", "'"), ("\t", '"'), ("|", "^"), (" ", "\\"), ("]", "[")):
        text = f"a{d}{q}b{d}\n{q}{q}c{q}{d}x{q}\n{q}{q}{d}e"
        assert framed(spark, {"f": text}, csv.Dialect(d, q))["f"] == walked(text, d, q)


def test_an_unclosed_record_ends_with_its_line(spark):
    files = {"f": 'a,"b\nc"\nd,"e\ng,""\n""', "g": "x,y\n1,2"}
    assert framed(spark, files) == {"f": [(1, ["a", "b\nc"]), (3, ["d", "e"]), (4, ["g", ""]), (5, [""])], "g": [(1, ["x", "y"]), (2, ["1", "2"])]}
    rejects = csv.split_malformed(csv.join_records(lines_of(spark, files)).filter("file = 'f'"), csv.Dialect(header=False), 2)[1]
    assert {(r["number"], r["kind"]) for r in rejects.collect()} == {(3, "parser"), (5, "width")}


def test_a_break_in_every_record_needs_no_task_over_the_file(spark, monkeypatch):
    """Windows run over blocks and over one row a block, never over the lines of a file."""
    monkeypatch.setattr(csv, "BLOCK", 100)
    lines = spark.range(1, 20_001).select(F.lit("f").alias("file"), F.col("id").alias("number"), F.when(F.col("id") % 2 == 1, F.concat("id", F.lit(',"a'))).otherwise('b"').alias("line"))
    rows = csv.join_records(lines)
    assert rows.count() == 10_000 and rows.filter('line NOT LIKE \'%,"a\nb"\'').count() == 0
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("block" in line for line in windows)


def test_wide_rows_as_narrow_ones(spark, monkeypatch):
    fields = [["1", "2.5", "true", " x "], ["-", None, "FALSE", ""], ["x", "1e3", "no", "é"]]
    good = spark.createDataFrame([("f", n, f) for n, f in enumerate(fields)], "file string, number long, fields array<string>").repartition(2)
    kinds = [T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()]
    schema = T.StructType([T.StructField(f"c{i}", k) for i, k in enumerate(kinds)])
    narrow = csv.as_columns(good, schema)
    monkeypatch.setattr(csv, "WIDE", 1)
    wide = csv.as_columns(good, schema)
    assert wide.schema == narrow.schema and sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    assert csv.as_columns(good.limit(0), schema, ()).collect() == []


def test_forty_thousand_columns_within_a_minute(spark, tmp_path):
    width = 40_001
    rows = [",".join(f'"c{i}"' if i % 9 == 0 else f"c{i}" for i in range(width)), *[",".join(str(i * k) if i % 2 else f"t{i}" for i in range(width)) for k in (1, 2, 3)]]
    (tmp_path / "wide.csv").write_text("\n".join(rows))
    begun = time.time()
    df = csv.scan_csv(spark, str(tmp_path / "wide.csv"))
    assert len(df.columns) == width and df.schema["c3"].dataType == T.LongType() and df.schema["c40000"].dataType == T.StringType()
    df.write.parquet(str(tmp_path / "out"))
    import pyarrow.dataset as ds

    table = ds.dataset(str(tmp_path / "out")).to_table(["c3", "c40000"])
    assert sorted(table["c3"].to_pylist()) == [3, 6, 9] and table["c40000"].to_pylist() == ["t40000"] * 3
    assert time.time() - begun < 60


def test_encodings_and_unusual_delimiters(spark, tmp_path):
    """Files are told apart by their bytes, wherever the first odd one is; unusual delimiters count where no usual one fits."""
    rows = [(i, f"na-me {i}", 3 * i) for i in range(400)]
    text = lambda d, odd="": "made of, this\n" + "".join(f"{a}{d}{b}{odd if a == 399 else ''}{d}{c}\n" for a, b, c in rows)
    files = {
        "utf8.csv": text(";", "é€").encode(), "mark.csv": text(";").encode("utf-8-sig"), "w1252.csv": text(",", "é€").encode("windows-1252"), "utf16.csv": text("\t", "é€").encode("utf-16"),
        "tilde.csv": text("~").encode(), "unit.csv": text("\x1f", "é").encode("windows-1252"), "colon.csv": text(":").encode(), "words.csv": b"one\ntwo\nthree\n",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {r["file"].rsplit("/", 1)[1]: (r["delimiter"], r["width"], r["preamble"], r["header"], r["encoding"]) for r in csv.sniff_csv(spark, str(tmp_path)).collect()}
    wanted = {"utf8.csv": (";", "UTF-8"), "mark.csv": (";", "UTF-8"), "w1252.csv": (",", "windows-1252"), "utf16.csv": ("\t", "UTF-16"), "tilde.csv": ("~", "UTF-8"), "unit.csv": ("\x1f", "windows-1252"), "colon.csv": (":", "UTF-8")}
    assert {f: g for f, g in got.items() if f != "words.csv"} == {f: (d, 3, 1, False, e) for f, (d, e) in wanted.items()}
    assert got["words.csv"][1:] == (1, 0, True, "UTF-8")
    dialect = csv.Dialect(",", preamble=1, header=False, encoding="windows-1252")
    read = csv.scan_csv(spark, str(tmp_path / "w1252.csv"), dialect)
    assert read.count() == 400 and read.filter("column_1 = 399").first()["column_2"] == "na-me 399é€"
