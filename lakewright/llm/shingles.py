"""N-gram Jaccard join of whole texts, with filters under several token orders.

1. Every text becomes its set of 5-word shingle hashes; equal sets have one key.
2. Short hashes of the tokens are dealt to buckets.  A bucket counts in how many
   distinct sets each token occurs; tokens of a single set can match nothing.
3. Each set meets its shared tokens again.  Sets with too few of them link with
   nothing.  The rest get their prefixes under several global orders (rarest
   first, and by two hashes): two linked sets share a token of each.
4. Candidates share a token of the first order's prefixes.  Those that share
   none under another order go before any set is fetched.
5. The sets that are left are made again from their texts, with whole 64-bit
   hashes, and compared.

Short hashes only ever let too much through: tokens that fall together count as
one token in common each time they occur, so no bound is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_BLANK, LOWER_ASCII, hashed_words, mixed, ngram_hashes, shared_folder, stored
from .similarity import linked_components

WORDS = 5
NUM, DEN = 80, 100
#: Seeds of the token orders whose filters are intersected with the first.
ORDERS = (2, 3)
#: Bytes of text whose tokens make one bucket, which a task holds at a time.
BUCKET_BYTES = 16 << 20
#: Bytes of text that are cut into tokens at a time, or one text.
SLICE_BYTES = 800_000
#: Postings of a token that one task joins.
SALT_SETS = 512


def shingle_sets(hashes: np.ndarray, sizes: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of many units (texts or lines) at once, given all their words' hashes and their numbers of words.

    A unit of fewer than ``words`` words has one shingle, all of it; one without
    words has none.  Returns the owners and hashes of all shingles, sorted by
    unit and hash, and each unit's number of shingles and key (equal sets have
    equal keys).
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word_owner = np.repeat(np.arange(len(sizes)), sizes)
    tokens, owners = [], []
    grams = ngram_hashes(hashes, words)
    if len(grams):
        inside = np.arange(len(grams)) + words <= ends[word_owner[: len(grams)]]
        tokens.append(grams[inside])
        owners.append(word_owner[: len(grams)][inside])
    for n in range(1, words):
        if len(short := np.flatnonzero(sizes == n)):
            # another length, another hash: a short text is no shingle of a longer one
            tokens.append(mixed(ngram_hashes(hashes, n)[starts[short]], n))
            owners.append(short)
    token, owner = np.concatenate([np.zeros(0, np.uint64), *tokens]), np.concatenate([np.zeros(0, np.int64), *owners])
    order = np.argsort(token)
    # by unit, and within by all bits of the token; short integers are sorted by digits
    order = order[np.argsort(owner[order].astype(np.min_scalar_type(len(sizes))), kind="stable")]
    token, owner = token[order], owner[order]
    if len(token):
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        token, owner = token[new], owner[new]
    n = np.bincount(owner, minlength=len(sizes))
    keys = np.zeros(len(sizes), np.uint64)
    if len(token):
        there = np.flatnonzero(n)
        keys[there] = np.add.reduceat(mixed(token, 11), (np.cumsum(n) - n)[there])
    return owner, token, n, mixed(keys + n.astype(np.uint64), 12)


def needed(n: np.ndarray | int):
    """Least overlap of a set of ``n`` tokens with any set it links to."""
    return -(-NUM * n // DEN)


def links_unequal(n: np.ndarray | int):
    """Whether a set of ``n`` tokens can link with any set but its equals; the next larger set has the most in common with it."""
    return DEN * n >= NUM * (n + 1)


def _pack_tokens(bucket: int, keys: np.ndarray, counts: np.ndarray, *columns: np.ndarray) -> bytes:
    """The tokens' bucket, sets' keys, how many of the tokens each has, and the tokens' columns."""
    kind = "<u1" if counts.max() < 256 else "<u4"
    return b"".join([b"T" if kind == "<u1" else b"W", np.asarray([bucket, len(keys)], "<u4").tobytes(), keys.astype("<u8").tobytes(), counts.astype(kind).tobytes(), *(c.tobytes() for c in columns)])


def _unpack_tokens(raw: bytes, *kinds: str) -> list[np.ndarray]:
    bucket, d = np.frombuffer(raw, "<u4", 2, 1).tolist()
    keys = np.frombuffer(raw, "<u8", d, 9)
    count_kind = "<u1" if raw[:1] == b"T" else "<u4"
    counts = np.frombuffer(raw, count_kind, d, 9 + 8 * d).astype(np.int64)
    at, n, out = 9 + (8 + np.dtype(count_kind).itemsize) * d, int(counts.sum()), [np.asarray([bucket], np.uint64), keys, counts]
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _pack_sizes(keys: np.ndarray, sizes: np.ndarray) -> bytes:
    return b"".join([b"S", keys.astype("<u8").tobytes(), sizes.astype("<u4").tobytes()])


def _unpack_sizes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    d = (len(raw) - 1) // 12
    return np.frombuffer(raw, "<u8", d, 1), np.frombuffer(raw, "<u4", d, 1 + 8 * d)


MIXED_SCHEMA = "doc_id long, version long, line int, n_shingles long, key long, bucket int, part binary"
MIXED_KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def _mixed_batch(rows: list, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """Rows of units, given as columns, then packed parts with their buckets."""
    d, p = len(rows[0]) if rows else 0, len(parts)
    columns = [pa.array(c, t) for c, t in zip(rows or [[]] * 6, MIXED_KINDS, strict=False)] + [pa.nulls(d, pa.binary())]
    rest = [pa.nulls(p, t) for t in MIXED_KINDS[:5]] + [pa.array([x[0] for x in parts], pa.int32()), pa.array([x[1] for x in parts], pa.binary())]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(pair) for pair in zip(columns, rest, strict=True)], names=[f.split()[0] for f in MIXED_SCHEMA.split(", ")])


def bucket_count(docs: DataFrame) -> int:
    """Buckets of tokens for all texts of ``docs``, by their bytes."""
    return 1 + (docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) // BUCKET_BYTES


def text_version(text: Column) -> Column:
    return F.xxhash64(text)


def _units(raws: list[bytes], lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, words a unit, document of each unit, line of each unit); a unit is a text, or a line with words."""
    joined = b" ".join(raws).translate(LOWER_ASCII)
    starts, hashes = hashed_words(joined, ASCII_BLANK)
    begins = np.cumsum([0, *(len(r) + 1 for r in raws[:-1])])
    doc = np.searchsorted(begins, starts, side="right") - 1
    if not lines:
        return hashes, np.bincount(doc, minlength=len(raws)), np.arange(len(raws)), np.zeros(len(raws), np.int64)
    breaks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)
    line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, begins)[doc]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return hashes, np.diff(np.append(first, len(doc))), doc[first], line[first]


def _slices(batch: pa.RecordBatch, docs: int = 500, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with so many documents and bytes of text at most, or one document."""
    lengths = np.diff(np.append(0, np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0)))))
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and (i - start >= docs or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(batch):
        yield batch.slice(start)


def spread(docs: DataFrame, buckets: int, lines: bool) -> DataFrame:
    """One row per text (or line with words), and packed parts: the tokens of each bucket, and the sizes of the sets by key.

    Sets so small that only equal sets link with them have no parts, as their
    keys are enough.
    ``version`` is a hash of the whole text, which tells rows with the same
    doc_id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        turn = TaskContext.get().partitionId() * 7919
        for whole in batches:
            for batch in _slices(whole):
                raws = [(text or "").encode("utf-8", "replace") for text in batch.column(1).to_pylist()]
                hashes, sizes, doc, line = _units(raws, lines)
                if not len(sizes):
                    continue
                owner, tokens, n, keys = shingle_sets(hashes, sizes)
                own_ids, versions = batch.column(0).take(pa.array(doc)), batch.column(2).take(pa.array(doc))
                turn += 1
                rows = [own_ids, versions, line.astype(np.int32), n, pa.array(keys.astype(np.int64), mask=n == 0), ((np.arange(len(n)) + turn) % buckets).astype(np.int32)]
                first = np.zeros(len(n), bool)
                first[np.unique(keys, return_index=True)[1]] = True
                fresh = first & links_unequal(n) & ~np.fromiter(map(seen.__contains__, keys.tolist()), bool, len(keys))
                if len(seen) < 200_000:
                    seen.update(keys[fresh].tolist())
                yield _mixed_batch(rows, [*_token_parts(keys, owner, tokens, fresh, buckets), *_size_parts(keys[fresh], n[fresh], buckets)])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_version(text).alias("version")).mapInArrow(run, MIXED_SCHEMA)


def _groups(target: np.ndarray, owner: np.ndarray, units: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of tokens by bucket and owner, owner and count of each group, groups before each bucket)."""
    place = target * units + owner
    order = np.argsort(place)
    place = place[order]
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    group = place[starts]
    return order, group % units, np.diff(np.append(starts, len(place))), np.searchsorted(group, np.arange(buckets + 1) * units)


def short_tokens(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, short hash in it) of tokens: from the high and the low half of their hashes."""
    return ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), tokens.astype(np.uint32)


def _token_parts(keys: np.ndarray, owner: np.ndarray, tokens: np.ndarray, fresh: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    own = fresh[owner]
    owner, tokens = owner[own], tokens[own]
    if not len(tokens):
        return []
    bucket, tokens = short_tokens(tokens, buckets)
    order, owners, counts, cuts = _groups(bucket, owner, len(keys), buckets)
    tokens = tokens[order]
    ends = np.append(0, np.cumsum(counts))
    out = []
    for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        g = slice(cuts[b], cuts[b + 1])
        t = slice(ends[cuts[b]], ends[cuts[b + 1]])
        out.append((b, _pack_tokens(b, keys[owners[g]], counts[g], tokens[t])))
    return out


def _size_parts(keys: np.ndarray, n: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    target = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(target)
    cuts = np.searchsorted(target[order], np.arange(buckets + 1))
    return [(b, _pack_sizes(keys[order[cuts[b] : cuts[b + 1]]], n[order[cuts[b] : cuts[b + 1]]])) for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()]


def _gathered(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> tuple[list[pa.RecordBatch], list[list[np.ndarray]]]:
    """Rows and parts with sizes as they are; parts with tokens unpacked."""
    plain, parts = [], []
    for batch in batches:
        packed = pa.compute.fill_null(pa.compute.not_equal(pa.compute.binary_slice(batch.column(6), 0, 1), b"S"), False)
        plain.append(batch.filter(pa.compute.invert(packed)))
        parts += [_unpack_tokens(x.as_py(), *kinds) for x in batch.filter(packed).column(6)]
    return [b for b in plain if len(b)], parts


def counted(spread: DataFrame, buckets: int) -> DataFrame:
    """Tokens of at least two distinct sets, packed for the bucket of each set's key, with their frequency; the rest stays."""

    def one_bucket(bucket: int, parts: list[list[np.ndarray]]) -> pa.RecordBatch | None:
        keys, counts, tokens = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        parts.clear()
        # a set that came from several tasks counts once
        order = np.argsort(keys, kind="stable")
        again = np.zeros(len(keys), bool)
        again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
        # tokens and owners in one number each, sorted in place
        both = np.repeat(np.where(again, -1, np.arange(len(keys))), counts)
        both = (tokens.astype(np.int64) << 31 | both)[both >= 0] if again.any() else tokens.astype(np.int64) << 31 | both
        both.sort()
        tokens, owner = (both >> 31).astype(np.uint32), (both & 0x7FFFFFFF).astype(np.int32)
        del both
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        frequency = np.diff(np.append(starts, len(tokens)))
        many = np.repeat(frequency > 1, frequency)
        tokens, owner, frequency = tokens[many], owner[many].astype(np.int64), np.repeat(frequency, frequency)[many]
        if not len(tokens):
            return None
        order, owners, counts, cuts = _groups((keys[owner] % np.uint64(buckets)).astype(np.int64), owner, len(keys), buckets)
        tokens, frequency = tokens[order], frequency[order].astype("<u4")
        ends = np.append(0, np.cumsum(counts))
        out = []
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            g = slice(cuts[b], cuts[b + 1])
            t = slice(ends[cuts[b]], ends[cuts[b + 1]])
            out.append((b, _pack_tokens(bucket, keys[owners[g]], counts[g], tokens[t], frequency[t])))
        return _mixed_batch([], out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, parts = _gathered(batches, ("<u4",))
        yield from plain
        del plain
        by_bucket: dict[int, list] = {}
        while parts:
            part = parts.pop()
            by_bucket.setdefault(int(part[0][0]), []).append(part)
            del part
        while by_bucket:
            found = one_bucket(*by_bucket.popitem())
            if found is not None:
                yield found

    return spread.repartitionById(buckets, F.col("bucket")).mapInArrow(run, MIXED_SCHEMA)


CANDIDATE_SCHEMA = "key long, n long, shared long, weight double, prefix array<long>, salts array<int>, others array<array<long>>"


def candidates(counted: DataFrame, buckets: int, orders: tuple[int, ...] = ()) -> DataFrame:
    """Sets that share enough tokens to link at all, with their filter prefixes.

    ``shared`` is the number of tokens that another set has too, ``weight`` the
    mean frequency of a set's tokens.  ``prefix`` holds the shared tokens of the
    first n - needed + 1 under the order of rarity (tokens of this set alone
    come first), ``salts`` into how many parts their postings are split, and
    ``others`` the prefixes under the orders by hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, parts = _gathered(batches, ("<u4", "<u4"))
        if not parts:
            return
        known = [_unpack_sizes(x.as_py()) for batch in plain for x in batch.column(6)]
        size_of = dict(zip(np.concatenate([k for k, _ in known]).tolist(), np.concatenate([n for _, n in known]).tolist(), strict=True))
        bucket = np.repeat(np.concatenate([p[0] for p in parts]), [len(p[3]) for p in parts])
        keys, counts, tokens, frequency = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3, 4))
        tokens = bucket << np.uint64(32) | tokens
        del bucket, parts
        distinct, place = np.unique(keys, return_inverse=True)
        n = np.fromiter(map(size_of.__getitem__, distinct.tolist()), np.int64, len(distinct))
        owner = np.repeat(place, counts)
        shared = np.bincount(owner, minlength=len(distinct))
        enough = shared >= needed(n)
        stay = enough[owner]
        tokens, frequency, owner = tokens[stay], frequency[stay], owner[stay]
        weight = (np.bincount(owner, weights=frequency, minlength=len(distinct)) + n - shared) / np.maximum(n, 1)
        order = np.lexsort((mixed(tokens, 1), frequency, owner))
        tokens, owner, salts = tokens[order], owner[order], 1 + frequency[order] // SALT_SETS
        edges = np.searchsorted(owner, np.arange(len(distinct) + 1))
        # of the first tokens of a set, those of this set alone come before all others
        lengths = n - needed(n) + 1 - (n - shared)
        other = [tokens[np.lexsort((mixed(tokens, seed), owner))].view(np.int64) for seed in orders]
        rows = []
        for i in np.flatnonzero(enough).tolist():
            own = slice(edges[i], edges[i] + lengths[i])
            rows.append((int(distinct[i].astype(np.int64)), int(n[i]), int(shared[i]), float(weight[i]), tokens[own].astype(np.int64), salts[own].astype(np.int32), [x[own] for x in other]))
            if len(rows) == 1000:
                yield _candidate_batch(rows)
                rows = []
        if rows:
            yield _candidate_batch(rows)

    return counted.filter("part IS NOT NULL").repartitionById(buckets, F.col("bucket")).mapInArrow(run, CANDIDATE_SCHEMA)


def _candidate_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key", "n", "shared", "weight", "prefix", "salts", "others"])


def exact_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, n, tokens) of the wanted sets (key, doc_id, version, line), made again from the texts.

    ``tokens`` are all whole 64-bit hashes of the set, sorted.  A null line
    means the whole text.
    """

    def made(keys: list[int], raws: list[bytes]) -> pa.RecordBatch:
        _, tokens, n, found = shingle_sets(*_units(raws, lines=False)[:2])
        if found.astype(np.int64).tolist() != keys:
            raise ValueError("a text has changed since its tokens were counted")
        cuts, raw = (8 * np.cumsum(n)).tolist(), tokens.astype("<u8").tobytes()
        parts = [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(parts, pa.binary())], names=["key", "n", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, raws, size = [], [], 0
        for batch in batches:
            for text, units in zip(batch.column(0), batch.column(1), strict=True):
                raw, lines = text.as_py().encode("utf-8", "replace"), None
                for unit in units.as_py():
                    if unit["line"] is not None and lines is None:
                        lines = raw.split(b"\n")
                    keys.append(unit["key"])
                    raws.append(raw if unit["line"] is None else lines[unit["line"]])
                    size += len(raws[-1])
                    if size > SLICE_BYTES or len(keys) >= 4000:
                        yield made(keys, raws)
                        keys, raws, size = [], [], 0
        if keys:
            yield made(keys, raws)

    own = wanted.groupBy("doc_id", "version").agg(F.collect_list(F.struct("key", "line")).alias("units"))
    own = own.select(F.col("doc_id").alias("unit_doc"), F.col("version").alias("unit_version"), "units")
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_version(text).alias("version"))
    met = texts.join(own, F.col("doc_id").eqNullSafe(F.col("unit_doc")) & (F.col("version") == F.col("unit_version")))
    # a repeated row gives its sets again
    return met.select("text", "units").mapInArrow(run, "key long, n long, tokens binary").dropDuplicates(["key"])


def posted(found: DataFrame, *columns: str) -> DataFrame:
    """A row for each prefix token of each candidate, with the least number of the set's tokens before it (``at``) and its salts."""
    rows = found.select(F.posexplode(F.arrays_zip("prefix", "salts")).alias("i", "token"), (F.col("n") - F.col("shared")).alias("alone"), "n", *columns)
    return rows.select(F.col("token.prefix").alias("token"), F.col("token.salts").alias("salts"), (F.col("alone") + F.col("i")).alias("at"), "n", *columns)


class Similar:
    """Documents' (or lines') rows, candidates and exact sets, each stored once."""

    def __init__(self, docs: DataFrame, folder: str, lines: bool, orders: tuple[int, ...] = ()):
        buckets = bucket_count(docs)
        shared = stored(counted(spread(docs, buckets, lines), buckets), f"{folder}/counted")
        self.rows = shared.filter("part IS NULL").select("doc_id", "version", "line", "n_shingles", "key")
        self.found = stored(candidates(shared, buckets, orders), f"{folder}/candidates")
        place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "version", "line")
        self.places = self.rows.filter("key IS NOT NULL").select("key", place.alias("place"))
        self.firsts = stored(self.places.groupBy("key").agg(F.min("place").alias("first"), F.max("place").alias("last")), f"{folder}/firsts")
        line = F.col("first.line") if lines else F.lit(None).cast("int")
        wanted = self.firsts.join(self.found.select("key"), "key").select("key", "first.doc_id", "first.version", line.alias("line"))
        self.sets = stored(exact_sets(docs, wanted), f"{folder}/sets")


def _components(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, version, n_shingles, key), and (key, label) of all keys: the component's smallest key."""
    similar = Similar(docs, folder, False, ORDERS)
    postings = posted(similar.found, "key", "weight").withColumn("most", F.col("n") - F.col("at")).drop("at")
    orders = similar.found.select("key", "others")
    linked = linked_components(postings, orders, similar.sets, folder, NUM, DEN)
    labels = similar.firsts.select("key").join(linked, "key", "left").select("key", F.coalesce("label", "key").alias("label"))
    return similar.rows.drop("line"), stored(labels, f"{folder}/labels")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Links are exact: 100 * common >= 80 * united shingles.  component_id is the
    smallest doc_id reachable, the document's own included.  Texts without
    words (also null) have no shingles and link with nothing.  Equal texts are
    one set.  Null ids stay null unless their component has another; repeated
    rows each get their row.  An empty table gives no rows.
    """
    rows, labels = _components(docs, shared_folder(docs.sparkSession, "shingles"))
    least = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least")).join(labels, "key")
    ids = least.groupBy("label").agg(F.min("least").alias("component_id")).join(labels, "label").select("key", "component_id")
    return rows.join(ids, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest doc_id, of several texts with that id the one of the smallest hash.

    Documents without words, and rows with a null id, link with nothing here
    and stay.  Of rows alike in id and text one stays: that whose other columns
    have the smallest hash.  The columns stay, whatever their names.
    """
    folder = shared_folder(docs.sparkSession, "kept")
    named = docs.filter("doc_id IS NOT NULL")
    rows, labels = _components(named, folder)
    best = rows.join(labels, "key").groupBy("label").agg(F.min(F.struct("doc_id", "version")).alias("best")).select("best.*")
    alone = rows.filter("key IS NULL").select("doc_id", "version")
    stay = stored(best.union(alone).distinct().select(F.col("doc_id").alias("kept_id"), F.col("version").alias("kept_version")), f"{folder}/stay")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    version = text_version(F.col("text").cast("string"))
    keyed = named.select(F.col("doc_id").cast("long").alias("id"), version.alias("version"), whole.alias("row"), F.xxhash64(F.to_json(rest)).alias("turn"))
    kept = keyed.join(stay, (F.col("id") == F.col("kept_id")) & (F.col("version") == F.col("kept_version")), "left_semi")
    once = kept.groupBy("id", "version").agg(F.min_by("row", "turn").alias("row"))
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]).unionByName(docs.filter("doc_id IS NULL"))


SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s FROM w),
x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL HAVING {DEN} * count(*) >= {NUM} * (any_value(a.n) + any_value(b.n) - count(*))),
c AS (SELECT doc_id, doc_id AS root FROM s UNION SELECT e.b, c.root FROM c JOIN (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) e ON e.a = c.doc_id WHERE c.root < e.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(c.root) AS component_id FROM s JOIN c ON c.doc_id = s.doc_id GROUP BY ALL
"""
