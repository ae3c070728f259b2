"""Token totals by source, language and tokenizer version, maintained by signed changes.

A batch of changes is reduced to one signed sum a key and added to the totals.
Counts of documents are kept as a ledger: a document that goes or is revised
takes back what the ledger says, and only new texts are tokenized.  Every writer
numbers its batches, and the manifest that publishes new totals also holds which
numbers of each writer it has, as ranges, so a batch that is sent twice, late,
or by a writer that died after its commit, counts once and none is lost.  A
manifest grows with the writers and with the gaps in their numbers, not with the
batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.manifests import Manifests
from .common import stored, token_counter

KEYS = ["source", "lang", "tokenizer"]
TOTALS_SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """One row a key with the signed sums of changes (source, lang, tokenizer, change, tokens, old_tokens).

    insert: +1 document, +tokens; delete: -1 and -tokens; revise: tokens minus
    old_tokens.  Null keys are keys of their own; null counts are 0.  Any other
    change fails.
    """
    tokens, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    kind = F.col("change")
    amount = F.when(kind == "insert", tokens).when(kind == "delete", -tokens).when(kind == "revise", tokens - old).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("null")))).cast("long"))
    count = F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0)
    return changes.groupBy(*KEYS).agg(F.sum(count).cast("long").alias("documents"), F.sum(amount).cast("long").alias("tokens"))


def _with(ranges: list[list[int]], number: int) -> list[list[int]]:
    """Ranges of numbers with one more; ranges that meet become one."""
    out: list[list[int]] = []
    for low, high in sorted([*ranges, [number, number]]):
        if out and low == out[-1][1] + 1:
            out[-1][1] = high
        else:
            out.append([low, high])
    return out


class TokenTotals:
    """Totals below ``root``, in versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, root)

    def _state(self) -> tuple[int, str | None, dict[str, list[list[int]]]]:
        version = self.manifests.newest()
        held = self.manifests.read(version) if version else {"folder": None, "writers": {}}
        return version, held["folder"], held["writers"]

    def _totals(self, folder: str | None) -> DataFrame:
        if folder is None:
            return self.spark.createDataFrame([], TOTALS_SCHEMA)
        return self.spark.read.schema(TOTALS_SCHEMA).parquet(f"{self.root}/{folder}")

    def totals(self) -> DataFrame:
        """Totals of all committed batches; keys without documents and tokens have no row."""
        return self._totals(self._state()[1])

    def commit(self, writer: str, number: int, changes: DataFrame) -> bool:
        """Add a writer's batch; False, and nothing read, if that number of the writer was added before.

        Numbers may come in any order.  A writer that loses a race gets
        ConcurrentCommit and may try again.  A batch without rows is a batch,
        too.
        """
        version, held, writers = self._state()
        ranges = writers.get(writer, [])
        if any(low <= number <= high for low, high in ranges):
            return False
        folder = f"totals/{version + 1:012d}-{uuid.uuid4().hex}"
        new = self._totals(held).unionByName(signed(changes)).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        stored(new.filter("documents <> 0 OR tokens <> 0"), f"{self.root}/{folder}")
        self.manifests.commit(version, {"folder": folder, "writers": {**writers, writer: _with(ranges, number)}})
        return True


def word_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


#: Tokenizer versions: vocabulary file, and whether a space belongs to the token after it.
TOKENIZERS = {"byte_bpe_50k-1": ("byte_bpe_50k.json", True), "word_bpe_49k-1": ("word_bpe_49k.json", False)}
CHANGE_SCHEMA = "source string, lang string, tokenizer string, change string, tokens long, old_tokens long"


def counted(docs: DataFrame, text: Column, keep: Iterable[str] = (), tokenizers: dict[str, tuple[str, bool]] = TOKENIZERS, entries: int = 800_000) -> DataFrame:
    """Ledger rows (source, lang, tokenizer, tokens, *keep) of all documents (source, lang, ...), one for each tokenizer version.

    Tokens are the ids of the whole text by the version's vocabulary, without
    special ones.  A null or empty text has none.  Repeated rows count each;
    other columns are not read.  Each worker keeps the numbers of at most
    ``entries`` words, or little more, for all vocabularies together.
    """
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(tuple(tokenizers.values()), entries)
        for batch in batches:
            counts = counter.count_all([t or "" for t in batch.column(2).to_pylist()])
            for version, tokens in zip(tokenizers, counts, strict=True):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([version] * len(batch), pa.string()), pa.array(tokens, pa.int64()), *batch.columns[3:]], names=["source", "lang", "tokenizer", "tokens", *keep])

    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), text.cast("string").alias("text"), *[F.col(f"`{c}`") for c in keep])
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(["source string, lang string, tokenizer string, tokens long", *[f"`{c}` {kinds[c]}" for c in keep]]))


def _changes(ledger: DataFrame, change: str, tokens: Column | None, old_tokens: Column | None) -> DataFrame:
    none = F.lit(None).cast("long")
    return ledger.select(*KEYS, F.lit(change).alias("change"), (none if tokens is None else tokens).alias("tokens"), (none if old_tokens is None else old_tokens).alias("old_tokens"))


def inserted(ledger: DataFrame) -> DataFrame:
    """Changes of documents that came."""
    return _changes(ledger, "insert", F.col("tokens"), None)


def deleted(ledger: DataFrame) -> DataFrame:
    """Changes of documents that go, by what they counted."""
    return _changes(ledger, "delete", F.col("tokens"), None)


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes of documents that are the same with other texts: what they counted goes, what they count comes."""
    return _changes(old, "revise", None, F.col("tokens")).unionByName(_changes(new, "revise", F.col("tokens"), None))
