"""The eight readers on captured bodies: many resources in, a Parquet table for each out, in one job a reader.

A reader turns bodies into rows (id, row, object, error), an object being the
JSON text of one row of one resource.  The columns of each resource are found by
grouping its objects, whatever the other resources look like, and tasks write
the tables, each task those that were dealt to it; a large resource is dealt in
blocks and becomes several files of one table.  Nothing loops over resources or
schemas.
"""

from __future__ import annotations

import functools
import io
import json
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import decode_bytes
from ..operators.ledger import outcome_summary
from ..operators.schema import unique_names
from ..plans.folders import file_system, shared_folder, stored
from . import csv, pages, transit
from .json import PACKAGE_TEXTS, TEXT_LIST, package_resource
from .routing import ORDER, Reader, can_read, ingest_resources

#: Rows of one file of a table, and bytes of JSON text of one row group.
FILE_ROWS, GROUP_BYTES = 1_000_000, 8 << 20
ROWS = "id string, row long, object string, error string"
#: Rows of one batch of a reader in Python; bodies of few rows share one.
BATCH_ROWS = 4096


@dataclass(frozen=True)
class TableReader:
    """A reader's name, its rows of bodies (id, format, url, file_name, start, page_url, content), and whether all their values are texts to be typed."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    texts: bool = False


def _row(number: Column, object_: Column, error: Column | None = None) -> list[Column]:
    return [F.col("id").cast("string").alias("id"), number.cast("long").alias("row"), object_.alias("object"), (F.lit(None) if error is None else error).cast("string").alias("error")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")], dtype=object)


def _text(bodies: DataFrame) -> DataFrame:
    return bodies.withColumn("body", decode_bytes(F.col("content")))


def _object(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(name) for name, c in columns.items()]), {"ignoreNullFields": "false"})


def _lines(bodies: DataFrame) -> DataFrame:
    """(file, number, line) of bodies; the line end at the end of a body starts no line."""
    lines = F.split(F.regexp_replace("body", r"\n\z", ""), "\n")
    return _text(bodies).select(F.col("id").cast("string").alias("file"), F.posexplode(lines).alias("i", "line")).select("file", (F.col("i") + 1).cast("long").alias("number"), "line")


def datastore_rows(bodies: DataFrame) -> DataFrame:
    """Records of datastore pages, from ``start`` on, under the names of a resource's first page; all texts, missing ones empty; pages from the first empty one on don't count."""
    body = _text(bodies).filter("content IS NOT NULL")
    field, record = (F.from_json(F.get_json_object("body", f"$.{name}"), kind) for name, kind in (("fields", "array<struct<id:string>>"), ("records", "array<array<string>>")))
    parsed = body.select("id", "start", F.transform(field, lambda f: f["id"]).alias("names"), record.alias("records"))
    whole = parsed.groupBy("id").agg(F.min_by("names", "start").alias("names"), F.min(F.when(F.size("records") == 0, F.col("start"))).alias("stop"), F.bool_or(F.col("names").isNull() | F.col("records").isNull()).alias("bad"))
    live = parsed.select("id", "start", "records").join(whole, "id").filter(F.col("stop").isNull() | (F.col("start") < F.col("stop")) | F.col("bad"))
    rows = live.filter("NOT bad").select("id", "start", "names", F.posexplode("records").alias("i", "r"))
    cells = F.transform("names", lambda n, i: F.coalesce(F.get("r", i), F.lit("")))
    good = rows.select(*_row(F.col("start") + F.col("i"), F.to_json(F.map_from_arrays("names", cells))))
    return good.unionByName(whole.filter("bad").select(*_row(F.lit(0), F.lit(None).cast("string"), F.lit("a page has no fields or records"))))


def csv_rows(bodies: DataFrame) -> DataFrame:
    """Records of CSV bodies in the dialect that each one's profile finds; a record of another width than the first is the resource's error."""
    folder = shared_folder(bodies.sparkSession, "csv-bodies")
    lines = stored(_lines(bodies), f"{folder}/lines")
    plain = lines.withColumn("line", F.regexp_replace("line", "\r$", ""))
    found = stored(csv.profile_csv(plain).select("file", "delimiter", "preamble", "header"), f"{folder}/profiles")

    # those in use, of some thirty that there are
    delimiters = [r[0] for r in found.select("delimiter").distinct().collect()] or list(csv.DELIMITERS)
    framed = csv.join_records(lines.join(found, "file").filter(F.col("number") > F.col("preamble")), delimiters=delimiters)
    line = F.regexp_replace("line", r"\r\z", "")
    cells = framed.select("file", "number", line.alias("line")).join(found.select("file", "delimiter"), "file")
    rows = stored(cells.select("file", "number", csv.by_delimiter(delimiters, lambda d: csv.split_fields(F.col("line"), d)).alias("cells")), f"{folder}/records")
    first = rows.groupBy("file").agg(F.min("number").alias("first"), F.min_by("cells", "number").alias("names")).join(found.select("file", "header"), "file")
    blank = F.transform("names", lambda _: F.lit(""))
    unique = F.udf(unique_names, "array<string>")  # one call a resource
    named = first.select("file", "first", "header", F.size("names").alias("width"), unique(F.when(F.col("header"), F.transform("names", lambda n: F.coalesce(n, F.lit("")))).otherwise(blank)).alias("names"))
    body = rows.join(named, "file").filter((F.col("number") > F.col("first")) | ~F.col("header")).withColumnRenamed("file", "id")
    wrong = F.size("cells") != F.col("width")
    error = F.when(wrong, F.concat(F.lit("line "), "number", F.lit(": "), F.size("cells").cast("string"), F.lit(" fields for "), "width"))
    return body.select(*_row(F.col("number"), F.when(~wrong, F.to_json(F.map_from_arrays("names", F.transform("cells", csv.null_text)))), error))


def datapackage_rows(bodies: DataFrame) -> DataFrame:
    """Resources of a data package, under the id of the resource that it is."""
    listed = F.get_json_object("body", "$.resources")
    body = _text(bodies).select("id", listed.alias("listed"))
    empty = F.coalesce(F.json_array_length("listed"), F.lit(0)) == 0
    rows = body.filter(~empty).select("id", F.posexplode(F.from_json("listed", TEXT_LIST)).alias("i", "r"))
    one = {**package_resource(F.col("r")), "package_id": F.col("id").cast("string")}
    assert set(PACKAGE_TEXTS) < set(one)
    return rows.select(*_row(F.col("i"), _object(**one))).unionByName(body.filter(empty).select(*_row(F.lit(0), F.lit(None).cast("string"), F.lit("the package has no resources"))))


def json_rows(bodies: DataFrame) -> DataFrame:
    """Objects of JSON documents; of a feature collection its features, with properties, geometry as text and geometry_type."""
    whole = F.trim("body")
    body = _text(bodies).select("id", whole.alias("body"))
    collection = (F.get_json_object("body", "$.type") == "FeatureCollection") & F.get_json_object("body", "$.features").isNotNull()
    listed = F.when(F.coalesce(collection, F.lit(False)), F.get_json_object("body", "$.features")).when(F.col("body").startswith("["), F.col("body")).when(F.col("body").startswith("{"), F.concat(F.lit("["), "body", F.lit("]")))
    parsed = body.select("id", F.coalesce(collection, F.lit(False)).alias("geo"), F.when(F.try_parse_json(listed).isNotNull(), listed).alias("listed"))
    rows = parsed.filter("listed IS NOT NULL").select("id", "geo", F.posexplode(F.from_json("listed", TEXT_LIST)).alias("i", "o"))
    geometry = F.get_json_object("o", "$.geometry")
    properties = F.coalesce(F.get_json_object("o", "$.properties"), F.lit("{}"))
    shape = F.substring(_object(geometry=geometry, geometry_type=F.get_json_object(geometry, "$.type")), 2, 1 << 30)
    feature = F.concat(F.substring(properties, F.lit(1), F.length(properties) - 1), F.when(properties == "{}", "").otherwise(","), shape)
    clash = F.col("geo") & F.get_json_object(properties, "$.geometry").isNotNull()
    odd = ~F.col("o").startswith("{")
    error = F.when(odd, "a row is no object").when(clash, "a property is named geometry")
    bad = parsed.filter("listed IS NULL").select(*_row(F.lit(0), F.lit(None).cast("string"), F.lit("no JSON document")))
    return rows.select(*_row(F.col("i"), F.when(F.col("geo"), feature).otherwise(F.col("o")), error)).unionByName(bad)


def protobuf_rows(bodies: DataFrame) -> DataFrame:
    """Entities of transit feeds."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out: list[tuple] = []
            for key, content in zip(df["id"], df["content"], strict=True):
                try:
                    feed = transit.decode(bytes(content or b""), transit.FEED)
                    rows = [json.dumps(e) for e in feed.get("entity", [])]
                    error = None if "header" in feed else "the feed has no header"
                except (ValueError, KeyError, IndexError) as e:
                    rows, error = [], f"no feed: {e}"
                if error:
                    rows = [None]
                out += [(key, i, row, error) for i, row in enumerate(rows)]
                if len(out) >= BATCH_ROWS:
                    yield _frame(out)
                    out = []
            yield _frame(out)

    return bodies.select(F.col("id").cast("string").alias("id"), "content").mapInPandas(run, ROWS)


def log_rows(bodies: DataFrame) -> DataFrame:
    """Lines of logs, in order from 1."""
    lines = _lines(bodies).withColumnRenamed("file", "id")
    return lines.select(*_row(F.col("number"), _object(order=F.col("number"), message=F.regexp_replace("line", "\r$", ""))))


def reference_rows(bodies: DataFrame) -> DataFrame:
    """One row for a resource that is kept as a file."""
    kept = pages.file_references(bodies.select(F.col("id").cast("string").alias("id"), "url", "file_name", "format").distinct())
    return kept.select(*_row(F.lit(1), _object(url=F.col("url"), name=F.col("name"))))


def crawler_rows(wanted: str) -> Callable[[DataFrame], DataFrame]:
    """Sources that a crawl finds for a resource: files of the wanted format, archives and shared drives linked from its pages, and members of its archive."""

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out: list[tuple] = []
            for key, content in zip(df["id"], df["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
                        rows = [json.dumps({"kind": "member", "target": i.filename, "bytes": i.file_size}) for i in archive.infolist() if not i.is_dir()]
                    error = None
                except (zipfile.BadZipFile, ValueError) as e:
                    rows, error = [None], f"no archive: {e}"
                out += [(key, i, row, error) for i, row in enumerate(rows)]
                if len(out) >= BATCH_ROWS:
                    yield _frame(out)
                    out = []
            yield _frame(out)

    def rows(bodies: DataFrame) -> DataFrame:
        zipped = F.coalesce(F.substring("content", 1, 2) == F.lit(b"PK"), F.lit(False))
        members = bodies.filter(zipped).select(F.col("id").cast("string").alias("id"), "content").mapInPandas(entries, ROWS)
        html = _text(bodies.filter(~zipped)).select(F.col("id").cast("string").alias("id"), F.col("page_url").alias("url"), F.col("url").alias("root"), F.col("body").alias("html"))
        found = pages.crawl_sources(html, wanted)
        order = F.xxhash64("target").bitwiseAND(F.lit((1 << 62) - 1))
        return members.unionByName(found.select(*_row(order, _object(kind=F.col("kind"), target=F.col("target"), bytes=F.lit(None).cast("long")))))

    return rows


def library_readers(wanted: str = "CSV") -> list[TableReader]:
    """The readers in their fixed order."""
    made = (datastore_rows, csv_rows, datapackage_rows, json_rows, protobuf_rows, log_rows, reference_rows, crawler_rows(wanted))
    return [TableReader(name, rows, name == "csv") for name, rows in zip(ORDER, made, strict=True)]


def _layouts(rows: DataFrame, texts: bool) -> DataFrame:
    """(id, layout): what the columns of each resource are, over all its rows."""
    if not texts:
        return rows.groupBy("id").agg(F.schema_of_variant_agg(F.parse_json("object")).alias("layout"))
    cells = rows.select("id", F.posexplode(F.from_json("object", "map<string,string>")).alias("at", "name", "cell"))
    fits = [F.bool_and(F.when(F.col("cell").isNotNull(), csv.fits(F.col("cell"), k))).alias(k) for k, _ in csv.KINDS]
    kinds = cells.groupBy("id", "name").agg(F.min("at").alias("at"), *fits)
    kind = reduce(lambda rest, k: F.when(F.col(k[0]), k[0]).otherwise(rest), reversed(csv.KINDS), F.lit("string"))
    return kinds.groupBy("id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("at", "name", kind.alias("kind"))))).alias("layout"))


PLAIN = {"BIGINT": pa.int64(), "bigint": pa.int64(), "DOUBLE": pa.float64(), "double": pa.float64(), "DECIMAL": pa.float64(), "BOOLEAN": pa.bool_(), "boolean": pa.bool_()}


def arrow_fields(layout: str) -> list[tuple[str, pa.DataType]]:
    """Names and Arrow types of a layout: a JSON list of typed names, or the schema text of a variant; nulls and mixed kinds are text."""
    if layout.startswith("["):
        return [(c["name"], PLAIN.get(c["kind"], pa.string())) for c in json.loads(layout)]
    tokens = re.findall(r"`(?:[^`]|``)*`|[A-Z]+\(\d+,\d+\)|[^\s<>,:`]+|[<>,]", layout)
    at = 0

    def kind() -> pa.DataType:
        nonlocal at
        word, at = tokens[at].split("(")[0], at + 1
        if at >= len(tokens) or tokens[at] != "<":
            return PLAIN.get(word, pa.string())
        at, inner = at + 1, []
        while tokens[at] != ">":
            name = None
            if word == "OBJECT":
                name, at = tokens[at], at + 1
                name = name[1:-1].replace("``", "`") if name.startswith("`") else name
            inner.append((name, kind()))
            at += tokens[at] == ","
        at += 1
        return pa.list_(inner[0][1]) if word == "ARRAY" else pa.struct(inner) if inner else pa.string()

    whole = kind()
    return [(f.name, f.type) for f in whole] if pa.types.is_struct(whole) else []


@functools.lru_cache(1024)
def _columns(layout: str) -> tuple[list[tuple[str, pa.DataType]], pa.Schema]:
    """A layout's fields and its table's schema; many resources have the same."""
    fields = arrow_fields(layout)
    return fields, pa.schema(list(zip(unique_names([n for n, _ in fields]), [k for _, k in fields], strict=True)))


def _fit(value, kind: pa.DataType):
    """A JSON value as one of an Arrow type."""
    if value is None:
        return None
    if pa.types.is_string(kind):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if pa.types.is_list(kind):
        return [_fit(v, kind.value_type) for v in value]
    if pa.types.is_struct(kind):
        return {f.name: _fit(value.get(f.name), f.type) for f in kind}
    if pa.types.is_boolean(kind):
        return value if isinstance(value, bool) else value.lower() == "true"
    return int(value) if pa.types.is_integer(kind) else float(value)


def write_tables(rows: DataFrame, layouts: DataFrame, root: str, version: str) -> DataFrame:
    """(id, file, rows, columns, bytes) of the Parquet files of all resources of rows (id, row, object), by layouts (id, layout).

    A block of rows has a file name of its own and appears under it when it is
    complete, so a task that runs twice changes nothing.
    """
    blocks = rows.withColumn("block", F.floor(F.col("row") / FILE_ROWS)).select("id", "block", "row", "object")
    heads = blocks.select("id", "block").distinct().join(layouts, "id").select("id", "block", F.lit(None).cast("long").alias("row"), F.col("layout").alias("object"))
    # as many tasks as there are cores for, as few bytes may make many files
    spark = rows.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dealt = heads.unionByName(blocks).repartition(tasks, "id", "block").sortWithinPartitions("id", "block", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        table = None

        class Table:
            def __init__(self, key: str, block: int, layout: str):
                self.key, (self.fields, self.schema) = key, _columns(layout)
                self.folder = f"{base}/{key}/ducklake_{version}.parquet"
                self.path = f"{self.folder}/part-{block:05d}.parquet"
                self.temporary = f"{self.folder}/.{uuid.uuid4().hex}.tmp"
                self.out = None
                self.held, self.size, self.n = [], 0, 0

            def add(self, text: str) -> None:
                self.held.append(json.loads(text))
                self.size, self.n = self.size + len(text), self.n + 1
                if self.size > GROUP_BYTES:
                    self.flush()

            def open(self):
                fs.create_dir(self.folder, recursive=True)
                return fs.open_output_stream(self.temporary)

            def flush(self) -> None:
                if self.out is None:
                    self.sink = self.open()
                    self.out = pq.ParquetWriter(self.sink, self.schema)
                self.put()

            def put(self) -> None:
                if self.held:
                    columns = [pa.array([_fit(o.get(name), kind) for o in self.held], kind) for name, kind in self.fields]
                    self.out.write_table(pa.Table.from_arrays(columns, schema=self.schema))
                self.held, self.size = [], 0

            def close(self) -> tuple:
                if self.out is None:  # a small table is written at once
                    held = pa.BufferOutputStream()
                    self.out = pq.ParquetWriter(held, self.schema)
                    self.put()
                    self.out.close()
                    self.sink = self.open()
                    self.sink.write(held.getvalue())
                else:
                    self.put()
                    self.out.close()
                size = self.sink.tell()
                self.sink.close()
                fs.move(self.temporary, self.path)
                return self.key, self.path, self.n, len(self.fields), size

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(("id", "file", "rows", "columns", "bytes"), d, strict=True)) for d in done], schema=schema)

        for batch in batches:
            done = []
            for key, block, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row is None:
                    if table:
                        done.append(table.close())
                    table = Table(key, block, text)
                else:
                    table.add(text)
            if done:
                yield batch_of(done)
        if table:
            yield batch_of([table.close()])

    schema = pa.schema([("id", pa.string()), ("file", pa.string()), ("rows", pa.int64()), ("columns", pa.int64()), ("bytes", pa.int64())])
    return dealt.mapInArrow(run, "id string, file string, rows long, columns long, bytes long")


def ingest_tables(resources: DataFrame, captures: DataFrame, root: str, version: str, readers: list[TableReader] | None = None) -> tuple[DataFrame, DataFrame]:
    """(outcomes, files) of resources (id, format, url, file_name, datastore_active) read from captures (id, start, page_url, status, content).

    The readers go in turn as in ``ingest_resources``; a resource's tables are
    those of the reader that wins, below ``root``/id.  Outcomes are those of
    ``outcome_summary``, with all errors in the order of attempts.
    """
    spark = resources.sparkSession
    folder = shared_folder(spark, "ingest")
    readers = readers or library_readers()
    written: list[DataFrame] = []
    # bodies are met once and written by the readers that may take them, so each reader reads its own only
    takers = F.concat_ws(",", *[F.when(can_read(r.name), F.lit(r.name)) for r in readers])
    met = resources.join(captures.withColumnRenamed("id", "captured"), F.col("id") == F.col("captured"), "left").withColumn("takers", takers)
    met.write.partitionBy("takers").parquet(f"{folder}/bodies")
    met = spark.read.schema(met.schema).parquet(f"{folder}/bodies")

    def through(reader: TableReader) -> Reader:
        def read(mine: DataFrame) -> DataFrame:
            here = f"{folder}/{len(written)}"
            bodies = met.filter(F.array_contains(F.split("takers", ","), reader.name)).join(mine.select("id").distinct(), "id", "left_semi")
            answered = F.col("status").isNull() | (F.col("status") == 200)
            rows = stored(reader.rows(bodies.filter(answered & (F.col("content").isNotNull() | F.lit(reader.name == "file_reference")))), f"{here}-rows")
            refused = bodies.filter(~answered).select(F.col("id").cast("string").alias("id"), F.lit(-1).alias("row"), F.concat(F.lit("HTTP "), "status").alias("error"))
            errors = stored(rows.filter("error IS NOT NULL").select("id", "row", "error").unionByName(refused).groupBy("id").agg(F.min_by("error", "row").alias("error")), f"{here}-errors")
            good = rows.join(errors.select("id"), "id", "left_anti").select("id", "row", "object")
            files = stored(write_tables(good, _layouts(good, reader.texts), root, version), f"{here}-files")
            written.append(files.withColumn("reader", F.lit(reader.name)))
            counts = files.groupBy("id").agg(F.sum("rows").alias("rows")).withColumnRenamed("id", "counted")
            out = mine.select("id").join(counts, F.col("id").cast("string") == F.col("counted"), "left").join(errors.withColumnRenamed("id", "failed"), F.col("id").cast("string") == F.col("failed"), "left")
            return out.select("id", F.coalesce("rows", F.lit(0)).alias("rows"), "error")

        return Reader(reader.name, can_read(reader.name), read)

    ended = stored(ingest_resources(resources, [through(r) for r in readers]), f"{folder}/ended")
    files = reduce(DataFrame.unionByName, written).join(ended.filter("status = 'completed'").select(F.col("id").cast("string").alias("id"), "reader"), ["id", "reader"], "left_semi")
    widths = files.groupBy("id").agg(F.max("columns").alias("columns")).withColumnRenamed("id", "sized")
    sized = ended.join(widths, ended["id"].cast("string") == F.col("sized"), "left")
    none = F.lit(None).cast("long")
    outcomes = sized.select(F.col("id").alias("resource_id"), "reader", "rows", "columns", none.alias("expected_rows"), none.alias("expected_columns"), F.when(F.col("status") != "completed", F.when(F.col("errors") != "", F.col("errors")).otherwise(F.col("status"))).alias("error"), (F.col("status") == "deleted").alias("deleted"))
    return outcome_summary(outcomes), files.select("id", "reader", "file", "rows", "columns", "bytes")
