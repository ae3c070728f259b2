"""Token ids in binary shards, found through a minimal perfect hash index.

A shard file is the magic ``LWTOKS02``, the raw ids of its documents in
ascending ``doc_id`` order, and a footer: the id width in bytes (unsigned 32-bit
little-endian), the number of documents and of ids (unsigned 64-bit) and the
magic again.  Index files map a
document key to its place: a minimal perfect hash gives the slot, the slot
holds a 32-bit fingerprint of the key and the shard, offset and length.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NewFile, chunk_tokenizer, mixed, open_file, shared_folder, stored

MAGIC = b"LWTOKS02"
FOOTER = "<IQQ8s"
FOOTER_SIZE = struct.calcsize(FOOTER)
ENTRY_SCHEMA = "doc_id long, occurrence int, shard long, file string, token_offset long, n_tokens long"


def write_shards(docs: DataFrame, folder: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Tokenize all texts and write them in ``doc_id`` order; returns one entry per document.

    A null text is the single end id.  Null ids come first.  Rows with the same
    id are numbered by ``occurrence`` in order of their text.  A file carries
    the number of the task attempt that wrote it, and entries name the file, so
    a lost or repeated attempt leaves nothing that is ever read.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_tokenizer(vocabulary, spaces=False)
        width = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.asarray([end_id], "<u4").tobytes()
        task = TaskContext.get()
        name = f"{folder}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        total, count, last, seen = 0, 0, None, 0
        shard = NewFile(name)
        shard.write(MAGIC)
        for batch in batches:
            rows, chunks = [], []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode.encode_all(texts), strict=True):
                ids += end
                n = len(ids) // 4
                seen = seen + 1 if count and doc == last else 0
                last = doc
                chunks.append(ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())
                rows.append((doc, seen, task.partitionId(), name, total, n))
                total, count = total + n, count + 1
            shard.write(b"".join(chunks))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "occurrence", "shard", "file", "token_offset", "n_tokens"],
                )
        shard.write(struct.pack(FOOTER, width, count, total, MAGIC))
        shard.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, ENTRY_SCHEMA)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, by levels of bit vectors.

    At each level a key that shares its bit with no other key keeps it; the
    others try again one level below.  A key's slot is the number of set bits
    before its own, so n keys fill the slots 0 to n-1.  About 4 bits a key.
    """

    RATIO, LEVELS = 2, 40

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        ones = [np.concatenate([[0], np.cumsum(np.bitwise_count(b), dtype=np.int64)]) for b in bits]
        self.ranks, base = [], 0
        for r in ones:
            self.ranks.append(base + r)
            base += int(r[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            if len(levels) == cls.LEVELS:
                raise ValueError("two keys have the same 64-bit hash")
            size = 64 * max(1, -(-len(left) * cls.RATIO // 64))
            at = cls._place(left, len(levels), size)
            own = np.bincount(at, minlength=size)
            bits = (own == 1).reshape(-1, 64)
            levels.append((bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64))
            left = left[own[at] > 1]
        return cls(levels)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys, level + 1) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; -1 if no level knows it (then it is no key of the set)."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            at = self._place(keys[left], level, 64 * len(bits))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (ranks[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return out


def document_keys(doc_id: np.ndarray, is_null: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """64-bit keys; for an id's first occurrence the map is one to one."""
    base = mixed(doc_id.astype(np.int64).view(np.uint64), 7)
    base = np.where(is_null, mixed(np.zeros(len(base), np.uint64), 99), base)
    return np.where(occurrence > 0, mixed(base ^ mixed(occurrence.astype(np.uint64), 3), 5), base)


def _with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(buckets)).cast("int"))


def _arrays(df: pd.DataFrame) -> np.ndarray:
    return document_keys(df["doc_id"].fillna(0).to_numpy(np.int64), df["doc_id"].isna().to_numpy(), df["occurrence"].to_numpy(np.int64))


INDEX_SCHEMA = "bucket int, path string, keys long"


def build_index(entries: DataFrame, folder: str, buckets: int) -> DataFrame:
    """One index file per hash bucket of document keys; returns (bucket, path, keys).

    Choose ``buckets`` so that a bucket holds about a million keys: a task
    holds one bucket (some 40 bytes a key).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        whole = pd.concat(held, ignore_index=True)
        for bucket, df in whole.groupby("bucket"):
            keys = _arrays(df)
            table = PerfectHash.build(keys)
            slots = table.slots(keys)
            order = np.argsort(slots)
            files, file_at = np.unique(df["file"].to_numpy(str), return_inverse=True)
            parts = {
                "levels": np.asarray([len(b) for b in table.bits], np.int64),
                "bits": np.concatenate(table.bits),
                "fingerprints": (mixed(keys, 1000) >> np.uint64(32)).astype(np.uint32)[order],
                "file_at": file_at.astype(np.int32)[order],
                "offset": df["token_offset"].to_numpy(np.int64)[order],
                "length": df["n_tokens"].to_numpy(np.int64)[order],
                "files": np.frombuffer("\n".join(files).encode(), np.uint8),
            }
            path = f"{folder}/index-{bucket:06d}-{TaskContext.get().taskAttemptId()}.npz"
            packed = io.BytesIO()
            np.savez(packed, **parts)
            out = NewFile(path)
            out.write(packed.getvalue())
            out.close()
            yield pd.DataFrame({"bucket": [bucket], "path": [path], "keys": [len(keys)]})

    rows = _with_bucket(entries.select("doc_id", "occurrence", "file", "token_offset", "n_tokens"), buckets)
    return rows.repartitionById(buckets, F.col("bucket")).mapInPandas(run, INDEX_SCHEMA)


def lookup(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Places of the wanted keys (``doc_id``, ``occurrence``); unknown keys give no row."""
    paths = {r["bucket"]: r["path"] for r in index.collect()}  # one short row per index file

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[int, tuple] = {}
        for frame in frames:
            for bucket, df in frame.groupby("bucket"):
                if bucket not in paths:
                    continue
                if bucket not in opened:
                    opened.clear()
                    with open_file(paths[bucket]) as f:
                        parts = dict(np.load(io.BytesIO(f.read())))
                    cuts = np.cumsum(parts["levels"])[:-1]
                    opened[bucket] = PerfectHash(np.split(parts["bits"], cuts)), parts, np.array(parts["files"].tobytes().decode().split("\n"), object)
                table, parts, files = opened[bucket]
                wanted = _arrays(df)
                slots = table.slots(wanted)
                known = slots >= 0
                known[known] = parts["fingerprints"][slots[known]] == (mixed(wanted[known], 1000) >> np.uint64(32)).astype(np.uint32)
                at = slots[known]
                yield df.loc[known, ["doc_id", "occurrence"]].assign(file=files[parts["file_at"][at]], token_offset=parts["offset"][at], n_tokens=parts["length"][at])

    rows = _with_bucket(keys.select("doc_id", "occurrence"), buckets).repartitionById(buckets, F.col("bucket"))
    return rows.mapInPandas(run, "doc_id long, occurrence int, file string, token_offset long, n_tokens long")


def read_payloads(places: DataFrame, readers: int) -> DataFrame:
    """Read the ids at the given places, each file front to back; checks magic, footer and bounds."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source, width, total = None, None, 0, 0
        for df in frames:
            crcs = []
            for file, offset, n in zip(df["file"], df["token_offset"], df["n_tokens"], strict=True):
                if file != name:
                    name, source = file, open_file(file)
                    size = source.size()
                    source.seek(max(0, size - FOOTER_SIZE))
                    width, _, total, magic = struct.unpack(FOOTER, source.read(FOOTER_SIZE).rjust(FOOTER_SIZE, b"\0"))
                    if magic != MAGIC or size != len(MAGIC) + total * width + FOOTER_SIZE:
                        raise ValueError(f"{file} is not a whole token shard")
                if offset + n > total:
                    raise ValueError(f"{file} ends before the ids at {offset}")
                source.seek(len(MAGIC) + offset * width)
                ids = np.frombuffer(source.read(n * width), f"<u{width}").astype("<u4")
                if len(ids) != n:
                    raise ValueError(f"{file} is cut short")
                crcs.append(zlib.crc32(ids.tobytes()))
            yield df.assign(ids_crc32=crcs)

    # a slice of a file of 2^22 ids per group, so that no reader depends on one file's size
    placed = places.withColumn("slice", F.shiftright("token_offset", 22))
    ordered = placed.repartition(readers, "file", "slice").sortWithinPartitions("file", "token_offset").drop("slice")
    return ordered.mapInPandas(run, "doc_id long, occurrence int, file string, token_offset long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, folder: str | None = None, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, keys_per_index: int = 1_000_000) -> DataFrame:
    """Write all documents to token shards, index them, and read every one back by key.

    Returns doc_id, occurrence, start (ids of all documents before it),
    n_tokens and ids_crc32.  An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    entries = stored(write_shards(docs, folder, vocabulary, end_id), f"{folder}/entries")
    sums = entries.groupBy("file", "shard").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    shards = stored(sums, f"{folder}/manifest")
    total = shards.agg(F.sum("n")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(tasks, -(-total // 10_000)), -(-total // keys_per_index))
    index = stored(build_index(entries, folder, buckets), f"{folder}/index")
    keys = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().select("doc_id", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("k"))
    keys = keys.select("doc_id", (F.col("k") - 1).cast("int").alias("occurrence"))
    found = read_payloads(lookup(keys, index, buckets), tasks)
    # one row per shard file: as few as there are write tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(bases), "file").select("doc_id", "occurrence", (F.col("base") + F.col("token_offset")).alias("start"), "n_tokens", "ids_crc32")
