"""Helpers shared by the corpus operators: shared folders, files, tokens, hashes."""

from __future__ import annotations

import functools
import os
import posixpath
import re
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.folders import shared_folder  # noqa: F401 - used by the operators

_U64 = np.uint64

#: How tables are written: shuffle files go with the write that they were for, and Python workers get batches of bounded bytes.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def stored(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it again: the lineage ends at replicated files.

    The session's settings are the same afterwards.
    """
    conf = df.sparkSession.conf
    before = {name: conf.get(name, None) for name in WRITING}
    for name, value in WRITING.items():
        conf.set(name, value)
    try:
        df.write.parquet(path, compression=compression)
    finally:
        for name, value in before.items():
            conf.set(name, value) if value is not None else conf.unset(name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a column value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a plain path is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class NewFile:
    """A binary file that appears under its name only when it is complete."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


def open_file(uri: str):
    """Random-access input file of a URI."""
    fs, path = filesystem(uri)
    return fs.open_input_file(path)


def public_tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters that every Unicode version counts as such, in both cases: ASCII and the Latin blocks without the dotted capital I.
STEM = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
MARKS = ".,;:!?%&$#*"
#: Three blanks in a row, or two at the end: only such runs are cut by what stands around them.
BLANK_RUN = re.compile(r"\s\s(?:\s|\Z)")


class ChunkTokenizer:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Both vocabularies cut a text at white space before they merge bytes, so the
    ids of a text are the ids of its space-separated chunks in a row.  A chunk
    is tokenized once and then looked up; of a word with marks after it, word
    and marks are looked up apart.  With ``spaces`` the space before a chunk
    belongs to its first token, and a line feed starts a chunk of its own kind;
    a text with longer runs of white space, or with any at its start, is then
    tokenized as one piece, without the shortcut.  So is a text with the literal of an added token (as
    ``<|endoftext|>``), which is that token's id.  The cache holds ``entries``
    chunks; it starts again when it is full, which costs time but changes
    nothing.
    """

    def __init__(self, path: str, spaces: bool, entries: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaces, self.entries = spaces, entries
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        # tokens that begin (with spaces) or end (without) a word
        edge = (lambda token: token.startswith("\u0120")) if spaces else (lambda token: token.endswith("</w>"))
        self.edges = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.edges[[i for token, i in self.tokenizer.get_vocab().items() if edge(token)]] = True
        self._clear()

    def _clear(self) -> None:
        self.known = {"": self.direct(" ") if self.spaces else b"", "\n": self.direct("\n")}

    def direct(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, chunks: Iterable[str]) -> None:
        """Tokenize new chunks: plain words together and the others one by one."""
        words, marked, odd = set(), [], []
        for chunk in chunks:
            stem = chunk.rstrip(MARKS)
            if not ((stem.isascii() and stem.isalpha()) or STEM.fullmatch(stem)):
                odd.append(chunk)
            else:
                words.add(stem)
                if stem != chunk:
                    marked.append((chunk, stem))
        known = self.known
        self._learn_words([w for w in words if w not in known])
        for chunk, stem in marked:
            mark = chunk[len(stem) :]
            ids = self.marks.get(mark)
            if ids is None:
                ids = self.marks[mark] = self.direct(mark)
            known[chunk] = known[stem] + ids
        if odd:
            texts = [c if not self.spaces or c[0] == "\n" else " " + c for c in odd]
            done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            known.update((c, np.asarray(x.ids, "<u4").tobytes()) for c, x in zip(odd, done, strict=True))

    def _learn_words(self, words: list[str]) -> None:
        """Tokenize words of plain letters as one text and cut its ids at the words' edges."""
        for i in range(0, len(words), 512):
            some = words[i : i + 512]
            ids = np.asarray(self.tokenizer.encode_batch_fast([(" " if self.spaces else "") + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.edges[ids]) * 4 + (0 if self.spaces else 4)
            if len(at) != len(some):
                raise ValueError("the vocabulary cuts a word of plain letters")
            starts, ends = (at.tolist(), [*at[1:].tolist(), 4 * len(ids)]) if self.spaces else ([0, *at[:-1].tolist()], at.tolist())
            raw = ids.tobytes()
            self.known.update(zip(some, [raw[a:b] for a, b in zip(starts, ends, strict=True)], strict=True))

    def in_one_piece(self, text: str) -> bool:
        """Whether a text is tokenized as a whole."""
        return any(token in text for token in self.added) or (self.spaces and (text[:1].isspace() or BLANK_RUN.search(text) is not None))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.entries:
            self._clear()
        whole = list(map(self.in_one_piece, texts))
        if self.spaces:
            # a text is cut as if a line feed stood before it, whose id is then left out
            cut = [[] if odd or not text else ("\n" + text).replace("\n", " \n").split(" ")[1:] for odd, text in zip(whole, texts, strict=True)]
        else:
            cut = [[] if odd else text.replace("\n", " ").split(" ") for odd, text in zip(whole, texts, strict=True)]
        known = self.known
        if new := set().union(*cut).difference(known):
            self._learn(new)
        look, skip = known.__getitem__, 4 if self.spaces else 0
        return [self.direct(text) if odd else b"".join(map(look, chunks))[skip:] for odd, text, chunks in zip(whole, texts, cut, strict=True)]


class TokenCounter:
    """Numbers of ids of whole texts by several vocabularies at once.

    Texts are cut as in ``ChunkTokenizer``.  One table holds, for each chunk,
    its numbers by all vocabularies, packed in one integer, so a text is cut
    once and its chunks are looked up and added once.  The table holds
    ``entries`` chunks and starts again when it is full.
    """

    BITS = 40

    def __init__(self, vocabularies: Iterable[tuple[str, bool]], entries: int):
        self.parts = [ChunkTokenizer(public_tokenizer_path(name), spaces) for name, spaces in vocabularies]
        self.entries = entries
        self.known: dict[str, int] = {}
        self.same: dict[int, int] = {}

    def _learn(self, chunks: set[str]) -> None:
        """Of a plain word with marks after it, word and marks are counted apart, as ``ChunkTokenizer`` does."""
        known, marked, new = self.known, [], []
        stems = set()
        for chunk in chunks:
            stem = chunk.rstrip(MARKS)
            if stem == chunk or not ((stem.isascii() and stem.isalpha()) or STEM.fullmatch(stem)):
                new.append(chunk)
            else:
                marked.append((chunk, stem))
                if stem not in known:
                    stems.add(stem)
        new.extend(stems.difference(chunks))
        packed, marks = [0] * len(new), {chunk[len(stem) :]: 0 for chunk, stem in marked}
        for i, t in enumerate(self.parts):
            # without spaces in its tokens a vocabulary has no use for the line feed before a chunk
            keys = new if t.spaces else [c.removeprefix("\n") for c in new]
            t._learn(set(keys).difference(t.known))
            ids, shift = t.known, self.BITS * i
            packed = [p + (len(ids[key]) // 4 << shift) for p, key in zip(packed, keys, strict=True)]
            marks = {mark: n + (len(t.direct(mark)) // 4 << shift) for mark, n in marks.items()}
            t._clear()
        # few numbers are different, and each is kept once
        same = self.same.setdefault
        known.update((chunk, same(n, n)) for chunk, n in zip(new, packed, strict=True))
        for chunk, stem in marked:
            n = known[stem] + marks[chunk[len(stem) :]]
            known[chunk] = same(n, n)

    def count_all(self, texts: list[str]) -> list[list[int]]:
        """For each vocabulary the numbers of ids of the texts."""
        if len(self.known) > self.entries:
            self.known = {}
        cut = [("\n" + text).replace("\n", " \n").split(" ")[1:] if text else [] for text in texts]
        if new := set().union(*cut).difference(self.known):
            self._learn(new)
        look = self.known.__getitem__
        sums = [sum(map(look, chunks)) for chunks in cut]
        out = []
        for i, t in enumerate(self.parts):
            first = 1 if t.spaces else 0
            out.append([len(t.direct(text)) // 4 if t.in_one_piece(text) else (total >> self.BITS * i & (1 << self.BITS) - 1) - (first if text else 0) for text, total in zip(texts, sums, strict=True)])
        return out


@functools.cache
def token_counter(vocabularies: tuple[tuple[str, bool], ...], entries: int) -> TokenCounter:
    """One counter a worker process, so that the tasks it runs share what it has learned."""
    return TokenCounter(vocabularies, entries)


@functools.cache
def chunk_tokenizer(vocabulary: str, spaces: bool, entries: int = 700_000) -> ChunkTokenizer:
    """One tokenizer a worker process, so that the tasks it runs share what it has learned."""
    return ChunkTokenizer(public_tokenizer_path(vocabulary), spaces, entries)


_FACTOR = 0x9E3779B97F4A7C15 | 1


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2^64."""
    inverse = pow(_FACTOR, -1, 1 << 64)
    series = lambda f: np.concatenate([np.ones(1, _U64), np.multiply.accumulate(np.full(n - 1, f, _U64))])
    return series(_FACTOR), series(inverse)


def hashed_words(raw: bytes, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, 64-bit hashes) of the words of ``raw``, which are the runs of bytes that ``blank`` (256 booleans) doesn't mark.

    The hashes are polynomials over a word's bytes, taken as differences of one
    running sum over all bytes.
    """
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, _U64)
    data = np.frombuffer(raw, np.uint8)
    gap = np.concatenate([[True], blank[data], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(16, (len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, _U64)
    np.cumsum((data.astype(_U64) + _U64(1)) * up[: len(data)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * down[starts])


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; each seed gives another order."""
    x = (x + _U64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)).astype(_U64)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` word hashes, by position."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, _U64)
    value = words[:size].copy()
    for i in range(1, n):
        value *= _U64(0x100000001B3)
        value += words[i : size + i]
    return mixed(value)


#: The six ASCII white-space characters.
ASCII_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER_ASCII = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
