"""Stored objects and ZIP archives: listings, catalogue rows, member safety, and recursive expansion with limits."""

from __future__ import annotations

import hashlib
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import format_suffixes, stable_id
from ..plans.folders import file_system, shared_folder, stored


@dataclass(frozen=True)
class Limits:
    """Bounds of one root archive, its inner archives included."""

    archive_bytes: int = 8 << 30
    expanded_bytes: int = 64 << 30
    depth: int = 4
    entries: int = 100_000


def list_objects(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(object_key, last_modified, size) of all files below a root; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("path").alias("object_key"), F.col("modificationTime").alias("last_modified"), F.col("length").alias("size"))


def discover_archive_resources(members: DataFrame, source: str) -> DataFrame:
    """Catalogue rows (source_id, id, parent_id, kind, path) of members (category, year, member): categories, years and files."""
    name = lambda *parts: F.concat_ws("/", *parts)
    ident = lambda path: stable_id(F.concat(F.lit(f"{source}:"), path))
    rows = lambda df, kind, path, parent: df.select(F.lit(source).alias("source_id"), ident(path).alias("id"), (ident(parent) if parent is not None else F.lit(None).cast("string")).alias("parent_id"), F.lit(kind).alias("kind"), path.alias("path"))
    category, year, member = F.col("category"), name(F.col("category"), F.col("year").cast("string")), name(F.col("category"), F.col("year").cast("string"), F.col("member"))
    return rows(members.select("category").distinct(), "category", category, None).union(rows(members.select("category", "year").distinct(), "year", year, category)).union(rows(members, "file", member, year))


def unsafe_members(members: DataFrame) -> DataFrame:
    """Members (archive, member, symlink) with a name that must not be unpacked, or that occurs twice in its archive."""
    name = F.coalesce("member", F.lit(""))
    bad = (F.trim(name) == "") | name.startswith("/") | name.rlike(r"(^|/)\.\.(/|$)") | name.rlike(r"[\\!:\x00]") | F.coalesce("symlink", F.lit(False))
    twice = members.groupBy("archive", "member").agg(F.count("*").alias("n")).filter("n > 1").select("archive", "member", F.lit(True).alias("twice"))
    return members.join(twice, ["archive", "member"], "left").filter(bad | F.coalesce("twice", F.lit(False))).drop("twice")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the ZIP files below a path; no content is read."""
    return list_objects(spark, path, "*.zip").select(F.col("object_key").alias("file"), F.col("size").alias("length"))


ENTRIES = "root string, label string, file string, member string, position long, packed long, size long, method int, crc long, modified timestamp_ntz"


def _listed(archives: DataFrame) -> DataFrame:
    """Entries of archives (root, label, file): the directory at each file's end is read by ranges, and nothing else."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for root, label, file in zip(df["root"], df["label"], df["file"], strict=True):
                fs, path = file_system(file)
                with fs.open_input_file(path) as handle, zipfile.ZipFile(handle) as archive:
                    infos = [i for i in archive.infolist() if not i.is_dir()]
                    if any(i.flag_bits & 1 for i in infos):
                        raise ValueError(f"{label}: an entry is encrypted")
                    for at in range(0, len(infos), 10_000):
                        some = infos[at : at + 10_000]
                        yield pd.DataFrame(
                            {
                                "root": root,
                                "label": label,
                                "file": file,
                                "member": [i.filename for i in some],
                                "position": [i.header_offset for i in some],
                                "packed": [i.compress_size for i in some],
                                "size": [i.file_size for i in some],
                                "method": [i.compress_type for i in some],
                                "crc": [i.CRC for i in some],
                                "modified": [pd.Timestamp(*i.date_time) for i in some],
                            }
                        )

    return archives.select("root", "label", "file").mapInPandas(run, ENTRIES)


def _unpacked(handle, row, label: str, piece: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of an entry, a piece at a time, held to the size and checksum that the directory tells."""
    handle.seek(row.position)
    head = handle.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"{label}: {row.member} has no entry at its place")
    handle.seek(row.position + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    if row.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{label}: {row.member} is packed by method {row.method}")
    inflate = zlib.decompressobj(-15) if row.method == zipfile.ZIP_DEFLATED else None
    left, size, crc = int(row.packed), 0, 0
    while left or (inflate and inflate.unconsumed_tail):
        raw = inflate.unconsumed_tail if inflate and inflate.unconsumed_tail else handle.read(min(left, piece))
        if not raw:
            raise ValueError(f"{label}: {row.member} is cut short")
        if not (inflate and inflate.unconsumed_tail):
            left -= len(raw)
        data = inflate.decompress(raw, piece) if inflate else raw
        size, crc = size + len(data), zlib.crc32(data, crc)
        if size > row.size:
            break
        yield data
        if inflate and inflate.eof:
            break
    if inflate and size <= row.size:
        data = inflate.flush()
        size, crc = size + len(data), zlib.crc32(data, crc)
        yield data
    if size != row.size or crc != row.crc:
        raise ValueError(f"{label}: {row.member} has another size than its entry says, or another content")


def _dealt(entries: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Entries over tasks by place, those of a task in the order of their places."""
    return entries.repartition("file", "position").sortWithinPartitions("file", "position").mapInPandas(run, schema)


def _inner(entries: DataFrame, folder: str) -> DataFrame:
    """Archives (root, label, file) inside of archives, unpacked to files of a shared folder, each by a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for row in df.itertuples():
                name = hashlib.sha256(f"{row.label}!/{row.member}@{row.position}".encode()).hexdigest()
                fs, path = file_system(f"{folder}/{name}.zip")
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                source, place = file_system(row.file)
                temporary = f"{path}.{uuid.uuid4().hex}.tmp"
                with source.open_input_file(place) as handle, fs.open_output_stream(temporary) as out:
                    for data in _unpacked(handle, row, row.label):
                        out.write(data)
                fs.move(temporary, path)
                yield pd.DataFrame({"root": [row.root], "label": [f"{row.label}!/{row.member}"], "file": [f"{folder}/{name}.zip"]})

    return _dealt(entries, run, "root string, label string, file string")


def expand_archives(files: DataFrame, wanted: str, limits: Limits = Limits()) -> DataFrame:
    """(label, name, modified, content) of the members of archives (file, length, ...) that match a format.

    Directories are read by ranges, and members are dealt over tasks one by
    one, so neither the size of an archive nor its number of members bounds
    what can be read.  Inner archives are unpacked to shared files first and
    opened likewise, level by level; their label is outer!/inner.  A root
    archive that is over a limit, all inner ones counted, is an error before
    any member is unpacked.  A member that unpacks to another size or checksum
    than its entry says is an error, too.  A member of 2 GiB or more is too
    large for a cell.  No archives: no rows.
    """
    folder = shared_folder(files.sparkSession, "archives")
    level = files.select(F.col("file").alias("root"), F.col("file").alias("label"), "file")
    zipped = F.lower("member").endswith(".zip")
    levels: list[DataFrame] = []
    too_large = files.filter(F.col("length") > limits.archive_bytes).select("file").first()
    if too_large:
        raise ValueError(f"{too_large[0]}: the archive is too large")
    while True:
        entries = stored(_listed(level), f"{folder}/{len(levels)}-entries")
        levels.append(entries)
        spent = reduce(DataFrame.unionByName, levels).groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        over = spent.filter((F.col("n") > limits.entries) | (F.col("bytes") > limits.expanded_bytes)).select("root").first()
        if over:
            raise ValueError(f"{over[0]}: too many entries or bytes")
        inner = entries.filter(zipped)
        large = inner.filter(F.col("size") > limits.archive_bytes).select("label", "member").first()
        if large:
            raise ValueError(f"{large[0]}!/{large[1]}: the archive is too large")
        if inner.isEmpty():
            break
        if len(levels) == limits.depth:
            raise ValueError(f"{inner.first()['label']}: archives are nested too deeply")
        level = stored(_inner(inner, f"{folder}/{len(levels)}-files"), f"{folder}/{len(levels)}-inner")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, handle = None, None
        for df in frames:
            held, size = [], 0
            for row in df.itertuples():
                if row.size >= 1 << 31:
                    raise ValueError(f"{row.label}: {row.member} is too large for a cell")
                if row.file != opened:
                    if handle:
                        handle.close()
                    fs, path = file_system(row.file)
                    opened, handle = row.file, fs.open_input_file(path)
                held.append((f"{row.label}!/{row.member}", row.member.rsplit("/", 1)[-1], row.modified, b"".join(_unpacked(handle, row, row.label))))
                size += row.size
                if size > 16 << 20:
                    yield pd.DataFrame(held, columns=["label", "name", "modified", "content"])
                    held, size = [], 0
            if held:
                yield pd.DataFrame(held, columns=["label", "name", "modified", "content"])
        if handle:
            handle.close()

    suffixes = reduce(lambda a, b: a | b, [F.lower("member").endswith(end) for end in format_suffixes(wanted)], F.lit(False))
    members = reduce(DataFrame.unionByName, levels).filter(suffixes & ~zipped)
    return _dealt(members, run, "label string, name string, modified timestamp_ntz, content binary")
