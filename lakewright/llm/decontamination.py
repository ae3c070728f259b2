"""Benchmark decontamination by winnowing.

A fingerprint is the smallest 5-gram hash of a run of 13 words, so every shared
run of 13 words shares a fingerprint.  Documents and benchmark items are
fingerprinted in tasks and joined on their fingerprints; every match is extended
word by word in both directions, and runs of at least 13 equal words are hits.
An item of fewer words is one window; its fingerprint is the smallest 5-gram
hash (of under five words: the hash) of all its words, and documents give the
same minima for the few lengths that such items have.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_BLANK, hashed_words, mixed, ngram_hashes, shared_folder, stored

#: ASCII digits and letters (in lower case) and all bytes of other characters; the rest separates words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
SPAN, GRAM = 13, 5
VERDICT = "struct<n_words:long,n_hit:long,n_items:long,items_sha256:string,contaminated:boolean>"


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """64-bit hashes of the words of each text."""
    raws = [(text or "").encode("utf-8", "replace") for text in texts]
    starts, hashes = hashed_words(b" ".join(raws).translate(WORD_BYTES), ASCII_BLANK)
    return np.split(hashes, np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws[:-1]])))


def fingerprints(words: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Distinct fingerprints of a text: for windows of 13 words, and for each of the sizes under 13."""
    found = [window_minima(ngram_hashes(words, GRAM))] if len(words) >= SPAN else []
    for n in sizes:
        if len(words) >= n:
            grams = ngram_hashes(words, min(n, GRAM))
            found.append(mixed(np.lib.stride_tricks.sliding_window_view(grams, n - GRAM + 1).min(axis=1) if n > GRAM else grams, n))
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *found]))


def window_minima(hashes: np.ndarray) -> np.ndarray:
    """Smallest of every 9 neighbouring 5-gram hashes, that is of every 13 words."""
    two = np.minimum(hashes[:-1], hashes[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    return np.minimum(eight[:-1], hashes[8:])


class BenchmarkIndex:
    """Fingerprints of benchmark items, and where they stand.

    Items of under 13 words, which no window of 13 can hold, are looked up by
    the hash of all their words.
    """

    def __init__(self, items: list[tuple[str, np.ndarray]]):
        self.names = [name for name, _ in items]
        self.words = [words for _, words in items]
        places: dict[int, set[tuple[int, int]]] = {}
        self.short: dict[int, dict[int, list[int]]] = {}
        for item, words in enumerate(self.words):
            n = len(words)
            if 0 < n < SPAN:
                self.short.setdefault(n, {}).setdefault(int(ngram_hashes(words, n)[0]), []).append(item)
            elif n:
                grams = ngram_hashes(words, GRAM)
                minima = set(window_minima(grams).tolist())
                for at, value in enumerate(grams.tolist()):
                    if value in minima:
                        places.setdefault(value, set()).add((item, at))
        self.places = places
        self.fingerprints = np.sort(np.fromiter(places, np.uint64, len(places)))
        self.short_values = {n: np.fromiter(v, np.uint64, len(v)) for n, v in self.short.items()}

    def matches(self, words: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items with occurring windows."""
        hit, found = np.zeros(len(words), bool), set()
        if len(words) >= SPAN and len(self.fingerprints):
            grams = ngram_hashes(words, GRAM)
            minima = window_minima(grams)
            at = np.searchsorted(self.fingerprints, minima)
            at[at == len(self.fingerprints)] = 0
            if (same := self.fingerprints[at] == minima).any():
                shared = np.unique(minima[same])
                tried = set()
                for p in np.flatnonzero(np.isin(grams, shared)).tolist():
                    for item, q in self.places[int(grams[p])]:
                        if (item, p - q) not in tried:
                            tried.add((item, p - q))
                            self._extend(words, item, p - q, hit, found)
        for n, values in self.short_values.items():
            if len(words) >= n:
                grams = ngram_hashes(words, n)
                for p in np.flatnonzero(np.isin(grams, values)).tolist():
                    found.update(self.short[n][int(grams[p])])
                    hit[p : p + n] = True
        return hit, found

    def _extend(self, words: np.ndarray, item: int, shift: int, hit: np.ndarray, found: set[int]) -> None:
        """Mark all runs of at least 13 equal words on this alignment of text and item."""
        own = self.words[item]
        low, high = max(0, shift), min(len(words), shift + len(own))
        equal = np.concatenate([[False], words[low:high] == own[low - shift : high - shift], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start >= SPAN:
                hit[low + start : low + end] = True
                found.add(item)


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, list[str | None]]]:
    """Start and texts of parts of a column with so many characters at most, or one text."""
    start, held, length = 0, [], 0
    for i, text in enumerate(texts):
        value = text.as_py()
        if held and length + len(value or "") > size:
            yield start, held
            start, held, length = i, [], 0
        held.append(value)
        length += len(value or "")
    if held:
        yield start, held


def _items(benchmark: DataFrame, size: int) -> DataFrame:
    """(item, item_key, n, words, prints) of the distinct items that have words; ``words`` are their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch.column(2), size):
                words = word_hashes(texts)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(w) for w in words], pa.int32()),
                        pa.array([w.tobytes() for w in words], pa.binary()),
                        pa.array([fingerprints(w, [len(w)] if 0 < len(w) < SPAN else []).view(np.int64) for w in words], pa.list_(pa.int64())),
                    ],
                    names=["item", "item_key", "n", "words", "prints"],
                )

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    return rows.select("item", F.xxhash64("item", "text").alias("item_key"), "text").mapInArrow(run, "item string, item_key long, n int, words binary, prints array<long>").filter("n > 0")


def _prints(texts: DataFrame, sizes: list[int], size: int) -> DataFrame:
    """(version, prints) of texts (version, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in _slices(batch.column(1), size):
                prints = [fingerprints(w, sizes).view(np.int64) for w in word_hashes(some)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(some)), pa.array(prints, pa.list_(pa.int64()))], names=["version", "prints"])

    return texts.select("version", "text").mapInArrow(run, "version long, prints array<long>")


def _extended(suspects: DataFrame) -> DataFrame:
    """(version, item, hits) of texts (version, text, held: items and their words): the places of the words that each item hits, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = functools.lru_cache(maxsize=64)(lambda words: BenchmarkIndex([("", np.frombuffer(words, np.uint64))]))
        for batch in batches:
            for version, text, held in zip(*batch.columns, strict=True):
                words = word_hashes([text.as_py()])[0]
                held = held.as_py()
                hits = [np.flatnonzero(index(h["words"]).matches(words)[0]) for h in held]
                yield pa.RecordBatch.from_arrays([pa.array([version.as_py()] * len(held), pa.int64()), pa.array([h["item"] for h in held], pa.string()), pa.array(hits, pa.list_(pa.int32()))], names=["version", "item", "hits"])

    return suspects.select("version", "text", "held").mapInArrow(run, "version long, item string, hits array<int>").filter(F.size("hits") > 0)


#: Parts of the texts that meet an item or a fingerprint apart, so that one of very many texts is joined by many tasks.
SALTS = 16


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _verdicts(docs: DataFrame, benchmark: DataFrame, folder: str, size: int) -> DataFrame:
    """(version, n_hit, items) of the texts with hits; equal texts have one version and one row."""
    items = stored(_items(benchmark, size), f"{folder}/items")
    sizes = sorted(r["n"] for r in items.filter(F.col("n") < SPAN).select("n").distinct().collect())  # twelve at most
    text = F.col("text").cast("string")
    texts = docs.select(F.xxhash64(text).alias("version"), text.alias("text")).filter("text <> ''")
    known = items.select("item_key", F.explode("prints").alias("print"))
    part = F.pmod("version", F.lit(SALTS)).cast("int").alias("salt")
    met = _prints(texts, sizes, size).select("version", part, F.explode("prints").alias("print")).join(_salted(known), ["print", "salt"])
    pairs = stored(met.select("version", "item_key").distinct(), f"{folder}/pairs")
    # items go to texts, which stand once each, and not texts to items
    held = pairs.withColumn("salt", part).join(_salted(items.select("item_key", "item", "words")), ["item_key", "salt"])
    held = held.groupBy("version").agg(F.collect_list(F.struct("item", "words")).alias("held"))
    suspects = texts.join(pairs.select("version").distinct(), "version", "left_semi").dropDuplicates(["version"])
    found = stored(_extended(suspects.join(held, "version")), f"{folder}/hits")
    places = found.select("version", F.explode("hits").alias("place")).distinct().groupBy("version").agg(F.count("*").alias("n_hit"))
    names = found.groupBy("version").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return stored(places.join(names, "version"), f"{folder}/verdicts")


def contamination(docs: DataFrame, benchmark: DataFrame, column: str, slice_size: int = 1_500_000) -> DataFrame:
    """``docs`` with a struct ``column``: n_words, n_hit, n_items, items_sha256, contaminated.

    A document word inside an occurrence of a benchmark window is hit.  A
    document is contaminated if words are hit and they are at least a twentieth.
    Null and empty texts have no words; null and empty items match nothing;
    repeated items count once; a null item_id counts as the id "null".
    ``column`` replaces a column of that name; all others stay, whatever their
    names.  ``slice_size`` bounds the characters (or is exceeded by one text)
    that a task hashes at a time.
    """
    verdicts = _verdicts(docs, benchmark, shared_folder(docs.sparkSession, "contamination"), slice_size).withColumnRenamed("version", "hit_version")
    text, columns = F.col("text").cast("string"), [c for c in docs.columns if c != column]
    n_words = F.coalesce(F.regexp_count(text, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")), F.lit(0)).cast("long")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.xxhash64(text).alias("version"), n_words.alias("n_words"))
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    verdict = F.struct(
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
    joined = keyed.join(verdicts, F.col("version") == F.col("hit_version"), "left").select("row", verdict.alias("verdict"))
    return joined.select(*[F.col("row").getField(c).alias(c) for c in columns], F.col("verdict").alias(column))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows; the columns stay, whatever their names.

    Null and empty texts, of documents or of items, contain nothing and are
    contained in nothing.  Rows of one text share a verdict whatever their ids,
    null ones included, so repeated rows stay or go together, and there are no
    ties to settle.  An empty benchmark keeps all rows; no documents: no rows.
    """
    mark = "verdict"
    while mark in docs.columns:
        mark += "_"
    return contamination(docs, benchmark, mark).filter(~F.col(f"{mark}.contaminated")).drop(mark)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.gram = bw.gram),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
