"""Statistics of tables and files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.folders import file_system


def column_statistics(df: DataFrame) -> DataFrame:
    """(column, n_rows, nulls, least, most) of every column, in one pass."""
    names = df.columns
    c = lambda n: F.col(f"`{n}`")
    row = df.agg(F.count("*").alias("n"), *[F.struct(F.count(c(n)).alias("held"), F.min(c(n)).cast("string").alias("least"), F.max(c(n)).cast("string").alias("most")).alias(f"s{i}") for i, n in enumerate(names)])
    one = lambda i, n: F.struct(F.lit(n).alias("column"), F.col("n").alias("n_rows"), (F.col("n") - F.col(f"s{i}.held")).alias("nulls"), F.col(f"s{i}.least").alias("least"), F.col(f"s{i}.most").alias("most"))
    return row.select(F.inline(F.array(*[one(i, n) for i, n in enumerate(names)])))


def file_statistics(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, n_rows) of every Parquet file below a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))
    counts = spark.read.option("recursiveFileLookup", "true").parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))
    return files.join(counts, "path", "left").select("path", "bytes", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def file_footers(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, n_rows, metadata, columns) of every Parquet file below a path, from the footers, which tasks read.

    columns: path, field_id, size_bytes (compressed), null_count and
    n_values of each leaf column, over all row groups; a figure that a file
    doesn't tell is null.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))

    def ids(field, prefix: str, out: dict[str, int]) -> dict[str, int]:
        """Field ids of a schema's leaves by their path, with the names that Parquet gives to elements and entries."""
        name, kind = f"{prefix}{field.name}", field.type
        if pa.types.is_map(kind):
            for part, child in (("key", kind.key_field), ("value", kind.item_field)):
                ids(child.with_name(part), f"{name}.key_value.", out)
        elif pa.types.is_list(kind):
            ids(kind.value_field.with_name("element"), f"{name}.list.", out)
        elif pa.types.is_struct(kind):
            for child in kind:
                ids(child, f"{name}.", out)
        else:
            held = (field.metadata or {}).get(b"PARQUET:field_id")
            out[name] = None if held is None else int(held)
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out = []
            for file in df["file"]:
                fs, place = file_system(file)
                footer = pq.read_metadata(place, filesystem=fs)
                known: dict[str, int] = {}
                for field in footer.schema.to_arrow_schema():
                    ids(field, "", known)
                columns: dict[str, dict] = {}
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        entry = columns.setdefault(chunk.path_in_schema, {"path": chunk.path_in_schema, "field_id": known.get(chunk.path_in_schema), "size_bytes": 0, "null_count": 0, "n_values": 0})
                        entry["size_bytes"] += chunk.total_compressed_size
                        entry["n_values"] += chunk.num_values
                        nulls = chunk.statistics.null_count if chunk.statistics is not None and chunk.statistics.has_null_count else None
                        entry["null_count"] = None if nulls is None or entry["null_count"] is None else entry["null_count"] + nulls
                metadata = {k.decode("utf-8", "replace"): v.decode("utf-8", "replace") for k, v in (footer.metadata or {}).items()}
                out.append((footer.num_rows, metadata, list(columns.values())))
            yield pd.DataFrame({"file": df["file"], "bytes": df["bytes"], "n_rows": [o[0] for o in out], "metadata": [o[1] for o in out], "columns": [o[2] for o in out]})

    return files.mapInPandas(run, "file string, bytes long, n_rows long, metadata map<string,string>, columns array<struct<path:string,field_id:int,size_bytes:long,null_count:long,n_values:long>>")
