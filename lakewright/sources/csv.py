"""CSV as published: dialects found from the data, typed columns, malformed rows set apart and repaired.

Files are read as lines with Spark's text source (which gunzips by itself), so
every step is a plan over lines.  Lines carry their file and number.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalars import SINGLE_BYTES, decode_bytes
from ..plans.folders import shared_folder, stored

DELIMITERS = (",", ";", "\t", "|")


@dataclass(frozen=True)
class Dialect:
    """How a file is written; ``quote`` may be empty for none."""

    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    preamble: int = 0
    encoding: str = "UTF-8"

    def __post_init__(self):
        if len(self.delimiter.encode()) != 1:
            raise ValueError("a delimiter is one byte")


def null_text(c: Column) -> Column:
    """Null for an empty cell, blanks, and a dash between blanks."""
    return F.when(~c.rlike(r"^\s*-?\s*$"), c)


@dataclass(frozen=True)
class _Grammar:
    """Patterns of a dialect: a quote opens at a field's start only, two of them inside are one, and what follows the closing one is text."""

    delimiter: str
    quote: str

    @property
    def _parts(self) -> tuple[str, str, str]:
        d, q = re.escape(self.delimiter), re.escape(self.quote)
        inner = f"(?:[^{q}]++|{q}{q})*+"
        return d, q, inner

    @property
    def field(self) -> str:
        d, q, inner = self._parts
        return f"(?:{q}{inner}(?:{q}[^{d}]*+)?+|[^{d}]*+)"

    @property
    def _fields_to_open_quote(self) -> str:
        d, q, inner = self._parts
        return rf"(?:(?:{q}{inner}{q}[^{d}]*+|(?!{q})[^{d}]*+){d})*+{q}{inner}\z"

    @property
    def opens(self) -> str:
        """Matches a line that starts a record and ends inside quotes."""
        return rf"\A{self._fields_to_open_quote}"

    @property
    def stays_open(self) -> str:
        """Matches a line that starts and ends inside quotes."""
        d, q, inner = self._parts
        return rf"\A{inner}(?:\z|{q}[^{d}]*+{d}{self._fields_to_open_quote})"


def split_fields(line: Column, delimiter: str, quote: str = '"') -> Column:
    """Fields of a record; delimiters inside quotes don't count, and doubled quotes are one.

    Quotes count at a field's start only; elsewhere they are text, as is what
    stands between a closing quote and the delimiter.  An open quote takes the
    rest of the record.
    """
    if not quote:
        return F.split(line, re.escape(delimiter))
    grammar = _Grammar(delimiter, quote)
    q = re.escape(quote)
    parts = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(f"{re.escape(delimiter)}({grammar.field})"), 1)
    inside = rf"(?s)\A{q}((?:[^{q}]++|{q}{q})*+)(?:{q}(.*+))?+\z"
    doubled = F.lit(quote * 2)
    text = lambda x: F.concat(F.replace(F.regexp_extract(x, inside, 1), doubled, F.lit(quote)), F.regexp_extract(x, inside, 2))
    return F.transform(parts, lambda x: F.when(x.startswith(quote), text(x)).otherwise(x))


def quote_field(c: Column, delimiter: str, quote: str = '"') -> Column:
    """A field in quotes if it holds the delimiter, a quote or a line break."""
    special = F.contains(c, F.lit(delimiter)) | F.contains(c, F.lit(quote)) | c.rlike("[\r\n]")
    return F.when(special, F.concat(F.lit(quote), F.replace(c, F.lit(quote), F.lit(quote * 2)), F.lit(quote))).otherwise(c)


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", returns: bool = False, only: DataFrame | None = None) -> DataFrame:
    """(file, number from 1, line) of text files, or of those of a table ``only`` (file); numbers follow the order in each file.

    Files of UTF-8 and of single bytes are read line by line and numbered by
    position within each part of a file; other encodings are decoded a file at
    a time.  The carriage return at a line's end goes unless it ``returns``.
    """
    from .logs import number_lines

    end = "^\ufeff" if returns else "^\ufeff|\r$"
    name = encoding.lower().replace("_", "-")
    if name in ("utf-8", "utf8", *SINGLE_BYTES):
        line = F.col("value") if name.startswith("utf") else decode_bytes(F.col("value").cast("binary"), name)
        lines = number_lines(spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace(line, end, "").alias("line")))
        return lines if only is None else lines.join(only, "file", "left_semi")
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "content")
    files = files if only is None else files.join(only, "file", "left_semi")
    files = files.select("file", decode_bytes(F.col("content"), encoding).alias("body"))
    rows = files.select("file", F.posexplode(F.split(F.regexp_replace("body", "\n$", ""), "\n")).alias("i", "line"))
    return rows.select("file", (F.col("i") + 1).cast("long").alias("number"), F.regexp_replace("line", end, "").alias("line"))


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """(file, encoding) of text files, from all their bytes, line by line: UTF-16 by its mark, UTF-8 if every line is, else Windows-1252."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("id"))
    mark = F.hex(F.substring(F.col("value").cast("binary"), 1, 2))
    found = lines.groupBy("file").agg(F.min_by(mark, F.struct("start", "id")).alias("mark"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    return found.select("file", F.when(F.col("mark").isin("FFFE", "FEFF"), "UTF-16").when(F.col("utf8"), "UTF-8").otherwise("windows-1252").alias("encoding"))


def sniff_csv(spark: SparkSession, path: str, hint: str | None = None) -> DataFrame:
    """``profile_csv`` of files as they are: each is read in the encoding that its bytes are in."""
    folder = shared_folder(spark, "sniff")
    encodings = stored(file_encodings(spark, path), f"{folder}/encodings")
    kinds = [r[0] for r in encodings.select("encoding").distinct().collect()]  # three at most
    lines = [read_lines(spark, path, k, only=encodings.filter(F.col("encoding") == k).select("file")) for k in kinds]
    if not lines:
        lines = [read_lines(spark, path)]
    profiles = profile_csv(stored(reduce(DataFrame.unionByName, lines), f"{folder}/lines"), hint)
    return profiles.drop("encoding").join(encodings, "file")


#: Lines that are scanned as one run.
BLOCK = 1 << 16


def by_delimiter(delimiters: Iterable[str], of: Callable[[str], Column]) -> Column:
    """What ``of`` makes of a row's delimiter, one of a few; each pattern stays a constant."""
    return F.coalesce(*[F.when(F.col("delimiter") == d, of(d)) for d in delimiters])


def join_records(lines: DataFrame, dialect: Dialect = Dialect(), delimiters: Iterable[str] | None = None) -> DataFrame:
    """Lines (file, number, line) with the lines of each record in one, under the number of its first; preamble lines are left out.

    A line is a map from the state before it, outside or inside quotes, to the
    state after it.  Maps compose, so blocks of lines are scanned apart; the
    maps of a file's blocks, one row each, give the state at every block's
    start, and with it that of every line.  Lines without quotes map each state
    to itself and take no part.  Only lines of records over several lines are
    gathered.  A record that nothing closes ends with its line; empty lines
    outside quotes are no records.  With ``delimiters`` each line tells its own,
    one of these, in the column delimiter.
    """
    lines = lines.filter(F.col("number") > dialect.preamble)
    if not dialect.quote:
        return lines
    one = lambda name: lambda d: F.col("line").rlike(getattr(_Grammar(d, dialect.quote), name)).cast("int")
    bit = lambda name: one(name)(dialect.delimiter) if delimiters is None else by_delimiter(delimiters, one(name))
    quoted = lines.filter(F.contains("line", F.lit(dialect.quote)))
    # after it, if it starts outside, and if it starts inside
    maps = quoted.select("file", "number", F.floor(F.col("number") / BLOCK).alias("block"), bit("opens").alias("f0"), bit("stays_open").alias("f1")).filter("NOT (f0 = 0 AND f1 = 1)")

    def scanned(df: DataFrame, rows: Window) -> DataFrame:
        """Adds fixed, the state that the last constant map sets (null before any), and flips, whether maps since then swap the states."""
        swaps = F.sum(F.when(F.col("f0") > F.col("f1"), 1).otherwise(0)).over(rows)
        counted = df.withColumn("swaps", swaps)
        last = lambda c: F.last(F.when(F.col("f0") == F.col("f1"), F.col(c)), ignorenulls=True).over(rows)
        return counted.withColumn("fixed", last("f0")).withColumn("flips", (F.col("swaps") - F.coalesce(last("swaps"), F.lit(0))) % 2)

    def after(entry: Column) -> Column:
        return (F.coalesce("fixed", entry) + F.col("flips")) % 2

    in_block, in_file = Window.partitionBy("file", "block").orderBy("number"), Window.partitionBy("file").orderBy("block")
    local = scanned(maps, in_block.rowsBetween(Window.unboundedPreceding, 0))
    last = local.groupBy("file", "block").agg(F.max_by(F.struct("fixed", "flips"), "number").alias("m"))
    blocks = scanned(last.select("file", "block", "m.*").select("file", "block", after(F.lit(0)).alias("f0"), after(F.lit(1)).alias("f1")), in_file.rowsBetween(Window.unboundedPreceding, 0))
    entries = blocks.select("file", "block", F.coalesce(F.lag(after(F.lit(0))).over(in_file), F.lit(0)).alias("entry"))
    states = local.join(entries, ["file", "block"]).select("file", "block", "number", "entry", after(F.col("entry")).alias("out"))
    states = states.withColumn("into", F.coalesce(F.lag("out").over(in_block), "entry"))
    # openings and closings take turns; the one after a block's last is the first of a later block
    borders = states.filter(F.col("into") != F.col("out"))
    heads = borders.groupBy("file", "block").agg(F.min("number").alias("head")).withColumn("next", F.lead("head").over(in_file)).select("file", "block", "next")
    pairs = borders.withColumn("end", F.lead("number").over(in_block)).join(heads, ["file", "block"])
    pairs = pairs.select("file", F.col("number").alias("first"), F.coalesce("end", "next").alias("end"), "out").filter("out = 1 AND end IS NOT NULL")
    inside = pairs.select("file", "first", F.explode(F.sequence("first", "end")).alias("number"))
    marked = lines.join(inside, ["file", "number"], "left")
    whole = marked.filter("first IS NOT NULL").groupBy("file", "first").agg(F.array_sort(F.collect_list(F.struct("number", "line"))).alias("parts"))
    joined = whole.select("file", F.col("first").alias("number"), F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("line"))
    # as usual for CSV, a line without a character is no record
    return marked.filter("first IS NULL").select("file", "number", "line").filter(~F.col("line").rlike(r"\A\r?\z")).unionByName(joined)


def _named(cells: Column) -> Column:
    """Whether cells look like column names."""
    number = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    return F.forall(cells, lambda x: (F.trim(x) != "") & ~x.rlike(number)) & (F.size(F.array_distinct(cells)) == F.size(cells))


#: Other bytes that may part fields: ASCII marks, blanks and control characters, without those of words, quotes and line ends.
UNUSUAL = tuple(chr(i) for i in (*range(1, 9), *range(14, 33), *b"!#$%&*+-./:<=>?@\\^_`~") if chr(i) not in DELIMITERS)


def _cuts(rows: DataFrame, delimiters: Iterable[str]) -> DataFrame:
    """Widths of the lines cut by delimiters: one row a file, delimiter and width."""
    cut = F.array(*[F.struct(F.lit(d).alias("delimiter"), F.size(split_fields(F.col("line"), d)).alias("width")) for d in delimiters])
    cuts = rows.select("file", "number", F.contains("line", F.lit('"')).alias("quote"), F.inline(cut))
    return cuts.groupBy("file", "delimiter", "width").agg(F.count("*").alias("n"), F.min("number").alias("first"), F.max("quote").alias("quoted"))


def profile_csv(lines: DataFrame, hint: str | None = None) -> DataFrame:
    """(file, delimiter, width, quoted, preamble, share, header, encoding) from all lines of each file (file, number, line).

    Each usual delimiter cuts every line; the one whose most frequent width
    over one covers the largest share of lines wins, then the wider one.  Files
    of which none covers half of the lines are cut by all other bytes that
    could be one.  Lines before the first of that width are a preamble.  That
    first line is a header if its fields are all there, all different and no
    numbers.  A file with bytes that are no UTF-8 (read as replacement
    characters) is Windows-1252.  A hint of one byte is taken as it is.
    """
    rows = lines.filter(F.trim("line") != "")
    totals = rows.groupBy("file").agg(F.count("*").alias("total"), F.when(F.bool_or(F.contains("line", F.lit("\ufffd"))), "windows-1252").otherwise("UTF-8").alias("encoding"))
    score = F.struct(F.when(F.col("width") > 1, F.col("n")).otherwise(0), "width", F.negative("first"), "delimiter")
    best = lambda widths: widths.groupBy("file").agg(F.max_by(F.struct("delimiter", "width", "quoted", "first", "n"), score).alias("b"))
    folder = shared_folder(lines.sparkSession, "profiles")
    found = stored(best(_cuts(rows, (Dialect(hint).delimiter,) if hint is not None else DELIMITERS)).join(totals, "file").select("file", "b.*", "total", "encoding"), f"{folder}/usual")
    if hint is None:
        good = (F.col("width") > 1) & (2 * F.col("n") >= F.col("total"))
        rest = found.filter(~good)
        if not rest.isEmpty():
            others = best(_cuts(rows.join(rest.select("file"), "file", "left_semi"), UNUSUAL)).filter((F.col("b.width") > 1) & F.col("b.n").isNotNull()).withColumnRenamed("b", "c")
            better = rest.join(others, "file", "left")
            pick = F.when((F.col("c.n") * 2 >= F.col("total")), F.col("c")).otherwise(F.struct("delimiter", "width", "quoted", "first", "n"))
            found = stored(found.filter(good).unionByName(better.select("file", pick.alias("b"), "total", "encoding").select("file", "b.*", "total", "encoding")), f"{folder}/all")
    # the first lines are looked up, so that no other line's cells are looked at
    delimiters = (hint,) if hint is not None else (*DELIMITERS, *UNUSUAL)
    first = rows.select("file", F.col("number").alias("first"), "line")
    header = by_delimiter(delimiters, lambda d: _named(split_fields(F.col("line"), d)))
    return found.join(first, ["file", "first"]).select("file", "delimiter", "width", "quoted", (F.col("first") - 1).alias("preamble"), (F.col("n") / F.col("total")).alias("share"), header.alias("header"), "encoding")


KINDS = (("bigint", T.LongType()), ("double", T.DoubleType()), ("boolean", T.BooleanType()))
#: What a value of each kind looks like.
SHAPES = {"bigint": "^[+-]?[0-9]+$", "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", "boolean": "(?i)^(true|false)$"}


def fits(value: Column, kind: str) -> Column:
    """Whether a text is a value of a kind."""
    return value.try_cast(kind).isNotNull() & value.rlike(SHAPES[kind])


def infer_types(df: DataFrame) -> T.StructType:
    """Types of text columns, over all rows: long, double or boolean if every value is one, else text."""
    checks, names = [], []
    for i, c in enumerate(df.columns):
        value = null_text(F.col(f"`{c}`"))
        for kind, _ in KINDS:
            checks.append(F.coalesce(F.bool_and(F.when(value.isNotNull(), fits(value, kind))), F.lit(False)).alias(f"k{i}_{kind}"))
        names.append(c)
    found = df.agg(*checks).first()
    kind_of = lambda i: next((t for k, t in KINDS if found[f"k{i}_{k}"]), T.StringType())
    return T.StructType([T.StructField(c, kind_of(i)) for i, c in enumerate(names)])


def infer_field_types(good: DataFrame, width: int) -> list[T.DataType]:
    """As ``infer_types``, for the fields of rows: cells go by position, so that the plan stays the same for any width."""
    value = null_text(F.col("cell"))
    checks = [F.bool_and(F.when(value.isNotNull(), fits(value, k))).alias(k) for k, _ in KINDS]
    found = {r["at"]: r for r in good.select(F.posexplode("fields").alias("at", "cell")).groupBy("at").agg(*checks).collect()}  # one row a column
    return [next((t for k, t in KINDS if i in found and found[i][k]), T.StringType()) for i in range(width)]


def promote_columns(df: DataFrame, schema: T.StructType) -> tuple[T.StructType, bool]:
    """The schema with each column that holds a value of another type as text, and whether none had to change."""
    bad = lambda f: F.count_if(null_text(F.col(f"`{f.name}`")).isNotNull() & null_text(F.col(f"`{f.name}`")).try_cast(f.dataType).isNull())
    counts = df.agg(*[bad(f).alias(str(i)) for i, f in enumerate(schema.fields)]).first()
    fields = [T.StructField(f.name, T.StringType() if counts[str(i)] else f.dataType) for i, f in enumerate(schema.fields)]
    return T.StructType(fields), not any(counts)


def split_malformed(lines: DataFrame, dialect: Dialect, width: int, schema: T.StructType | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of lines (file, number, line).

    good has the fields; rejects say why: another number of fields (short rows
    are padded instead where not ``strict``), an open quote, or a value of
    another type than the schema's.
    """
    fields = split_fields(F.col("line"), dialect.delimiter, dialect.quote)
    rows = lines.filter(F.col("number") > dialect.preamble + int(dialect.header)).withColumn("fields", fields).withColumn("n", F.size("fields"))
    open_quote = F.lit(False) if not dialect.quote else F.col("line").rlike(_Grammar(dialect.delimiter, dialect.quote).opens)
    wrong = F.col("n") > width if not strict else F.col("n") != width
    if not strict:
        rows = rows.withColumn("fields", F.concat("fields", F.array_repeat(F.lit(None).cast("string"), F.greatest(F.lit(0), F.lit(width) - F.col("n")))))
    bad_type = F.lit(None).cast("string")
    for i, f in reversed(list(enumerate(schema.fields if schema else []))):
        value = null_text(F.get("fields", F.lit(i)))
        if not isinstance(f.dataType, T.StringType):
            bad_type = F.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), f.name).otherwise(bad_type)
    kind = F.when(open_quote, "parser").when(wrong, "width").when(bad_type.isNotNull(), "type")
    rows = rows.withColumn("kind", kind).withColumn("column", F.when(kind == "type", bad_type))
    good = rows.filter("kind IS NULL").select("file", "number", "fields")
    return good, rows.filter("kind IS NOT NULL").select("file", "number", "line", "kind", F.lit(width).alias("expected"), F.col("n").alias("actual"), "column")


#: Columns from which on cells are dealt to columns in tasks instead of by an expression each.
WIDE = 256


def as_columns(good: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ("file", "number")) -> DataFrame:
    """Fields as typed columns with null cells; ``keep`` stays.

    Wide rows are cast as one array for each type, and Arrow batches take their
    columns from these, so the plan is the same for 300 columns and for 40,000.
    """
    if len(schema.fields) < WIDE:
        cell = lambda i, f: null_text(F.get("fields", F.lit(i))).try_cast(f.dataType).alias(f.name)
        return good.select(*keep, *[cell(i, f) for i, f in enumerate(schema.fields)])
    kinds = list(dict.fromkeys(f.dataType for f in schema.fields))
    at = [kinds.index(f.dataType) for f in schema.fields]
    width = len(at)
    typed = lambda kind: F.transform("fields", lambda x: null_text(x).try_cast(kind))
    arrays = [typed(kind).alias(f"cells_{i}") for i, kind in enumerate(kinds)]
    kept = len(keep)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(kept + i).flatten() for i in range(len(kinds))]
            starts = pa.array(range(0, batch.num_rows * width, width), pa.int64())
            columns = [cells[k].slice(i).take(starts) if batch.num_rows else cells[k] for i, k in enumerate(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *columns], names=names)

    rows = good.select(*keep, *arrays)
    out = T.StructType([*rows.schema.fields[:kept], *schema.fields])
    names = out.fieldNames()
    return rows.mapInArrow(deal, out)


def merge_candidates(rejects: DataFrame, dialect: Dialect) -> DataFrame:
    """(file, number, at, merged) for each pair of neighbouring fields of rows that are too wide; ``at`` is the first of them, from 1."""
    fields = split_fields(F.col("line"), dialect.delimiter, dialect.quote)
    wide = rejects.filter("kind = 'width' AND actual > expected").withColumn("fields", fields)
    pairs = F.transform(F.sequence(F.lit(1), F.size("fields") - 1), lambda i: F.struct(i.alias("at"), F.concat(F.col("fields")[i - 1], F.lit(dialect.delimiter), F.col("fields")[i]).alias("merged")))
    return wide.select("file", "number", F.inline(pairs))


def repair_rows(lines: DataFrame, decisions: DataFrame, dialect: Dialect) -> DataFrame:
    """Lines with the fields ``at`` and ``at`` + 1 of each decision (file, number, at) joined and quoted again."""
    q = lambda x: quote_field(x, dialect.delimiter, dialect.quote or '"')
    joined = lines.join(decisions.select("file", "number", "at"), ["file", "number"], "left")
    f = split_fields(F.col("line"), dialect.delimiter, dialect.quote)
    merged = F.concat(F.element_at("f", F.col("at")), F.lit(dialect.delimiter), F.element_at("f", F.col("at") + 1))
    fields = F.concat(F.slice("f", F.lit(1), F.col("at") - 1), F.array(merged), F.slice("f", F.col("at") + 2, F.size("f")))
    return joined.withColumn("f", f).select("file", "number", F.when(F.col("at").isNull(), F.col("line")).otherwise(F.array_join(F.transform(fields, q), dialect.delimiter)).alias("line"))


def scan_csv(spark: SparkSession, path: str, dialect: Dialect | None = None, schema: T.StructType | None = None, strict: bool = True) -> DataFrame:
    """Rows of CSV files; without a schema the names are the header's and the types are inferred from all rows.

    Quoted fields may hold line breaks, which stay as they are.  The files are
    read once.
    In strict mode a short or long row is an error; else short rows are padded
    and only long ones are.
    """
    from ..operators.schema import unique_names

    dialect = dialect or Dialect()
    folder = shared_folder(spark, "csv-lines")
    lines = stored(read_lines(spark, path, dialect.encoding, returns=True), f"{folder}/lines")
    lines = stored(join_records(lines, dialect).withColumn("line", F.regexp_replace("line", r"\r\z", "")), f"{folder}/records")
    fields = split_fields(F.col("line"), dialect.delimiter, dialect.quote)
    first = lines.filter(F.col("number") == dialect.preamble + 1).select(fields.alias("f")).first()
    width = len(schema.fields) if schema else len(first["f"]) if first else 0
    good, rejects = split_malformed(lines, dialect, width, strict=strict)
    bad = rejects.limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['file']} line {bad[0]['number']}: {bad[0]['kind']}, {bad[0]['actual']} fields for {width}")
    names = [f.name for f in schema.fields] if schema else unique_names([x or "" for x in first["f"]] if dialect.header else [""] * width)
    schema = schema or T.StructType([T.StructField(n, t) for n, t in zip(names, infer_field_types(good, width), strict=True)])
    return as_columns(good, schema, ())
