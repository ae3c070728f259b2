"""Best-fit packing of token pieces into fixed-length sequences.

Hierarchical residual packing.  Every partition packs its own pieces best-fit;
bins that are nearly full are emitted.  The underfull bins travel on as items:
a tree merge gathers them in fewer and fewer partitions, and each round packs
them best-fit again, whole bins at a time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunk_tokenizer, shared_folder, stored

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces that one task packs in the first round, about 20 MB.
TASK_PIECES = 1 << 17
BIN_SCHEMA = f"{PIECE_SCHEMA}, bin long, offset long, fill long, done boolean"


def token_pieces(docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document; one row per piece.

    A document is its ids and then ``end_id``.  Only longer documents are cut:
    all pieces but the first have ``capacity`` ids.  A null or empty text is the
    single end id.  A null ``doc_id`` and repeated rows keep their own pieces.
    Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_tokenizer(vocabulary, spaces=True)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode.encode_all(texts), strict=True):
                ids += end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n % capacity or capacity) if not start else capacity
                    rows.append((doc, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    start, piece = start + length, piece + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE_SCHEMA)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item: largest item first, into the fullest bin that has room.

    Open bins are kept by their free space, with a bit for each space in use.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, count = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if above := free >> size:
            space = size + (above & -above).bit_length() - 1
            place = by_space[space].pop()
            if not by_space[space]:
                free &= ~(1 << space)
        else:
            space, place, count = capacity, count, count + 1
        bins[i], offsets[i] = place, capacity - space
        if space > size:
            by_space[space - size].append(place)
            free |= 1 << (space - size)
    return bins, offsets


def _pack_round(rows: DataFrame, capacity: int, slack: int, number: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        df = pd.concat(held, ignore_index=True)
        items = df.groupby("bin", sort=True)["fill"].first()
        bins, offsets = best_fit(items.to_numpy(), capacity)
        fill = np.bincount(bins, weights=items.to_numpy()).astype(np.int64)
        at = items.index.get_indexer(df["bin"])
        first = (number << 56) + (TaskContext.get().partitionId() << 32)
        df["offset"] += offsets[at]
        df["fill"] = fill[bins[at]]
        df["bin"] = first + bins[at]
        df["done"] = df["fill"] >= capacity - slack
        yield df

    return rows.mapInPandas(run, BIN_SCHEMA)


def _mergeable(table: DataFrame, capacity: int) -> Column:
    """Whether an underfull bin travels on.

    Two bins over half full never fit together, and a round leaves at most one
    bin up to half full in each partition.  All of these travel on, and of the
    fuller ones of each fill about twice as many, and 32, as there are such bins
    that fit in.  Which ones is told by a hash, as all of a fill are alike.
    """
    counts = dict(map(tuple, table.filter("NOT done AND offset = 0").groupBy("fill").count().collect()))
    small = {f: n for f, n in counts.items() if 2 * f <= capacity}
    part = []
    for fill, count in counts.items():
        takers = sum(n for f, n in small.items() if f + fill <= capacity)
        if 2 * fill > capacity and takers:
            part.append((fill, min(1 << 30, -(-((2 * takers + 32) << 30) // count))))
    share = F.lit(0)
    if part:
        fills, shares = (F.array(*map(F.lit, x)) for x in zip(*part, strict=True))
        share = F.coalesce(F.try_element_at(F.map_from_arrays(fills.cast("array<long>"), shares.cast("array<long>")), F.col("fill")), F.lit(0))
    return ~F.col("done") & ((2 * F.col("fill") <= capacity) | (F.pmod(F.xxhash64("bin"), F.lit(1 << 30)) < share))


def pack(pieces: DataFrame, capacity: int = 2048, slack: int | None = None, fan_in: int = 8) -> DataFrame:
    """Assign every piece a ``sequence_id`` and an ``offset`` in it.

    A bin counts as nearly full when at most ``slack`` places (1/128 of the
    capacity unless given) are free.  Each round joins ``fan_in`` partitions of
    underfull bins; the rounds end when one partition is left.  Bins that can
    take no other bin are emitted, so a partition of a later round holds few.
    Pieces are counted first, and partitions of few pieces are packed together,
    without a shuffle: how many sequences there are hardly depends on how the
    table was cut.  An empty table gives no rows.
    """
    folder = shared_folder(pieces.sparkSession, "packing")
    slack = capacity // 128 if slack is None else slack
    rows = pieces.coalesce(max(1, math.ceil(pieces.count() / TASK_PIECES)))
    rows = rows.withColumns({"bin": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "fill": F.col("length"), "done": F.lit(False)})
    parts, number, finished = 0, 1, []
    while True:
        table = stored(_pack_round(rows, capacity, slack, number), f"{folder}/round-{number}")
        underfull, last = table.agg(F.count_if(~F.col("done")), F.max(F.shiftright("bin", 32) % F.lit(1 << 24))).first()
        parts = parts or (last or 0) + 1
        if parts == 1 or not underfull:
            finished.append(table)
            break
        travels = _mergeable(table, capacity)
        finished.append(table.filter(~travels))
        parts = math.ceil(parts / fan_in)
        rows = table.filter(travels).repartition(parts, "bin")
        number += 1
    whole = reduce(DataFrame.unionByName, finished)
    return whole.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Cut and pack all documents: their pieces, each with a ``sequence_id`` and an ``offset``.

    A null or empty text is its end id alone.  A null id stays null, and
    repeated rows have pieces of their own; pieces of one length are alike, so
    ties don't matter.  Other columns are not read.  No documents: no rows.
    """
    pieces = stored(token_pieces(docs, capacity, vocabulary, end_id), shared_folder(docs.sparkSession, "pieces"))
    return pack(pieces, capacity)
