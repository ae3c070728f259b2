"""Lines in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def number_lines(lines: DataFrame) -> DataFrame:
    """(file, number, line): numbers from 1 in the order of each file.

    Rows keep the order in which the text source reads a file's parts.  Each
    partition counts its own lines; the counts of the partitions before (one
    row for each partition and file) are added.
    """
    marked = lines.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33))
    local = marked.withColumn("k", F.row_number().over(Window.partitionBy("part", "file").orderBy("id")))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy("file", "part").count().select("file", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return local.join(starts, ["file", "part"]).select("file", (F.col("start") + F.col("k")).alias("number"), "line")


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """(order from 1, message) of a log; one line end goes from each line, blank lines stay."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r$", "").alias("line"))
    return number_lines(lines).select(F.col("number").alias("order"), F.col("line").alias("message"))
