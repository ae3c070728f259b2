"""The corpus operators bound to their tables: queries and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boilerplate, compaction, conversations, decontamination, infilling, line_dedup, mixing, packing, quality, rollups, shingles, token_files, warc
from .common import shared_folder, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return boilerplate.main_texts(table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages in Zstandard web archives, read back record by record."""
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 5-word shingle sets have a similarity of 0.8 or more."""
    return shingles.jaccard_components(table(spark, sf_dir, "documents"))


def op4_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, arrived one language after the other, compacted, and read from the newest manifest."""
    docs = table(spark, sf_dir, "documents")
    store = compaction.ShardStore(spark, shared_folder(spark, "store"))
    arrivals = sorted((r[0] for r in docs.select("lang").distinct().collect()), key=lambda x: (x is None, x))
    for lang in arrivals:
        store.append(docs.filter(F.col("lang").eqNullSafe(F.lit(lang))))
    if not arrivals:
        store.append(docs)
    store.compact()
    store.expire()
    return store.read().select("doc_id", "source", "lang", "n_chars", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("text_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchical residual packing of all documents into sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised verdicts on all documents."""
    return quality.rate(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed matches of all documents with all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), "verdict").select("doc_id", "verdict.*")


def op8_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of both tokenizers after all documents came, came again, lost those under 50 words and were stripped of symbols."""
    text = F.col("text")
    words = rollups.word_count(F.coalesce(text, F.lit("")))
    docs = table(spark, sf_dir, "documents").select("source", "lang", "text", (words < 50).alias("short"), F.coalesce(text.rlike("[#*$%&|<>]"), F.lit(False)).alias("marked"))
    folder = shared_folder(spark, "totals")
    store = rollups.TokenTotals(spark, folder)
    ledger = stored(rollups.counted(docs, text, ["short", "marked"]), f"{folder}/ledger")
    store.commit("load", 1, rollups.inserted(ledger))
    store.commit("load", 1, rollups.inserted(ledger))
    # the revision arrives before the deletion that its writer numbered first
    stripped = rollups.counted(docs.filter("marked AND NOT short"), F.regexp_replace(text, "[#*$%&|<>]", ""))
    store.commit("rules", 2, rollups.revised(ledger.filter("marked AND NOT short"), stripped))
    store.commit("rules", 1, rollups.deleted(ledger.filter("short")))
    return store.totals()


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and remaining texts (as digests) of all documents."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in token shards, read back by key through the perfect hash index."""
    return token_files.token_files(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, and repaired with the cheapest edits."""
    return conversations.damage_report(table(spark, sf_dir, "conversations"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to one and a half times their words, with weights 3, 1, 2 and at most two epochs."""
    return mixing.planned(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into prefix, middle and suffix, and restored."""
    return infilling.digests(infilling.transformed(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_warc": op2_warc,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_compaction": op4_compaction,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontamination": op7_decontamination,
    "op8_token_rollups": op8_token_rollups,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_files": op10_token_files,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_mixing": op12_source_mixing,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc": warc.SQL,
    "op3_ngram_jaccard_join": shingles.SQL,
    "op4_compaction": compaction.SQL,
    "op6_quality_rules": quality.SQL,
    "op7_decontamination": decontamination.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op11_conversation_repair": conversations.SQL,
    "op12_source_mixing": mixing.SQL,
    "op13_fill_in_middle": infilling.SQL,
}
