"""Named tables of a lake: views, SQL over them, and what they look like."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Lake:
    """Data frames registered by name."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, {}

    def register(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        self.tables[name] = df

    def query(self, sql: str, **args) -> DataFrame:
        return self.spark.sql(sql, args=args or None)

    def profile(self) -> DataFrame:
        """Rows and columns of every table."""
        one = lambda name, df: df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        return reduce(DataFrame.unionByName, [one(n, df) for n, df in self.tables.items()])


def preview(df: DataFrame, rows: int = 5, most: int = 1000) -> DataFrame:
    """The first rows as text; a value of more than ``most`` bytes is replaced by a note of its size."""
    from ..functions.scalars import as_json_text

    def shown(name: str, kind: str) -> Column:
        text = as_json_text(F.col(f"`{name}`"), kind)
        size = F.octet_length(text)
        return F.when(size > most, F.concat(F.lit("["), size, F.lit(" bytes]"))).otherwise(text).alias(name)

    return df.limit(rows).select(*[shown(n, k) for n, k in df.dtypes])


def preview_columns(c: Column) -> Column:
    """Number of keys of the first object in a JSON array."""
    return F.size(F.json_object_keys(F.get_json_object(c, "$[0]")))
