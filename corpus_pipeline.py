"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept.  All but the last return the columns of ``documents``, and any further
columns whatever their names.  ``run`` writes each stage's result as Parquet in
the shared folder and reads it for the next, so a lost executor costs one stage
at most.  A table without rows gives none at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import decontamination, line_dedup, packing, quality, shingles
from lakewright.llm.common import shared_folder, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts with them; repeated rows share a verdict."""
    return quality.kept_documents(docs)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents of which nothing is left; n_chars follows.

    Lines are in order of ids (null last), then of the texts' hashes, then of
    their numbers; rows alike in id and text are one document and stay or go
    together.  Null and empty texts stay.
    """
    return line_dedup.without_repeats(docs, drop_emptied=True).withColumn("n_chars", F.length("text").cast("long"))


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id, of several texts with it the one of the smallest hash.

    Of rows alike in id and text one stays.  Rows with a null id, and texts
    without words, are like no other and stay.
    """
    return shingles.one_of_each_group(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark passages go; null and empty texts contain none and stay, repeated rows share a verdict."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 ids; a null text is empty, a null id stays null, and repeated rows have their own pieces."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", unique_lines),
    ("n-gram Jaccard join", unique_documents),
    ("benchmark decontamination", clean_of_benchmarks),
    ("best-fit packing", packed),
]

#: Greedy packing has no SQL; tests hold every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/stage-{i}")
    return docs
