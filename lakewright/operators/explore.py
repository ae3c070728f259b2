"""Exploration of one table: chosen columns, filters, grouping, order and pages, without assembled SQL text."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = 100
BOUND = 10_000
OPERATORS = ("equals", "notEquals", "greater", "less", "contains", "null", "notNull")
AGGREGATES = {"count": None, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def _column(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        raise ValueError(f"unknown column: {name}")
    return F.col("`" + name.replace("`", "``") + "`")


def predicate(df: DataFrame, column: str, operator: str, value: str | None = None) -> Column:
    """One filter; the value is a text that is cast to the column's type, and ``contains`` looks at the column's text."""
    c = _column(df, column)
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator: {operator}")
    if operator == "null":
        return c.isNull()
    if operator == "notNull":
        return c.isNotNull()
    if operator == "contains":
        return F.coalesce(F.contains(c.cast("string"), F.lit(value)), F.lit(False))
    typed = F.lit(value).cast(df.schema[column].dataType)
    return {"equals": c == typed, "notEquals": c != typed, "greater": c > typed, "less": c < typed}[operator]


def explore(
    df: DataFrame,
    columns: Sequence[str] = (),
    filters: Sequence[tuple] = (),
    order: str | None = None,
    descending: bool = False,
    offset: int = 0,
    group: str | None = None,
    measure: str | None = None,
    aggregate: str = "count",
    tie_break: Sequence[str] = (),
    limit: int = PAGE,
) -> DataFrame:
    """A page of a table.

    All filters must hold.  With ``group`` the rows are a group's value and
    ``valor``, its count or the aggregate of ``measure``.  Nulls come last in
    either direction.  ``tie_break`` columns make the order total.
    """
    if offset < 0:
        raise ValueError("the offset is negative")
    if aggregate not in AGGREGATES:
        raise ValueError(f"unknown aggregate: {aggregate}")
    chosen = [_column(df, c) for c in columns]
    for f in filters:
        df = df.filter(predicate(df, *f))
    if group is not None:
        value = F.count(F.lit(1)) if aggregate == "count" else AGGREGATES[aggregate](_column(df, measure))
        df = df.groupBy(_column(df, group)).agg(value.alias("valor"))
    elif chosen:
        df = df.select(*chosen, *[_column(df, c) for c in [order, *tie_break] if c and c not in columns]) if order or tie_break else df.select(*chosen)
    keys = [(_column(df, order), descending)] if order else []
    keys += [(_column(df, c), False) for c in tie_break]
    if keys:
        df = df.orderBy(*[c.desc_nulls_last() if down else c.asc_nulls_last() for c, down in keys])
    out = df.offset(offset).limit(limit)
    return out.select(*chosen) if chosen and group is None else out


def bind(params: Sequence) -> list:
    """Parameters of a statement: null, text, boolean, finite number or integer; anything else is an error."""
    for p in params:
        if not (p is None or isinstance(p, (str, bool, int)) or isinstance(p, float) and math.isfinite(p)):
            raise ValueError(f"not a parameter: {p!r}")
    return [F.lit(p) for p in params]


def bounded_query(spark: SparkSession, sql: str, params: Sequence = (), limit: int = BOUND) -> tuple[DataFrame, bool]:
    """At most ``limit`` rows of one relational statement, and whether there were more."""
    text = re.sub(r";\s*$", "", sql.strip())
    if ";" in re.sub(r"'[^']*'|\"[^\"]*\"|`[^`]*`", "", text):
        raise ValueError("one statement at a time")
    if not re.match(r"(?is)\s*(select|with|values|table|from)\b", text):
        raise ValueError("a relational statement is expected")
    df = spark.sql(text, args=bind(params)) if params else spark.sql(text)
    more = df.offset(limit).limit(1).count() > 0
    return df.limit(limit), more


def page(df: DataFrame, keys: Sequence[Column], limit: int = 50, offset: int = 0) -> DataFrame:
    """A page in the order of ``keys``, whose last should be unique; limit 1 to 500."""
    if not 1 <= limit <= 500 or offset < 0:
        raise ValueError("limit must be 1 to 500 and offset not negative")
    return df.orderBy(*keys).offset(offset).limit(limit)


def top_k(df: DataFrame, keys: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*keys).limit(k)


def top_by_amount(df: DataFrame, group: str, amount: Column, year: Column, wanted: int, n: int = 5) -> DataFrame:
    """The ``n`` groups with the largest sums in one year; amounts are localized texts."""
    from ..functions.scalars import parse_local_number

    rows = df.filter(year == wanted).groupBy(F.col(group).alias("programme")).agg(F.round(F.sum(parse_local_number(amount)), 2).alias("total"))
    return rows.orderBy(F.desc("total"), "programme").limit(n)


def number_batches(df: DataFrame, key: str, size: int = 1000, first: int | None = None) -> DataFrame:
    """Rows in the order of ``key`` with batch numbers from 1, ``size`` rows each; only the ``first`` rows if given.

    Numbers come from each key's rank: counts of range partitions are summed,
    so no task sees more than its own range.
    """
    ranked = ranks(df, key)
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.withColumn("batch", (F.floor((F.col("rank") - 1) / size) + 1).cast("long")).drop("rank")


def ranks(df: DataFrame, key: str, out: str = "rank", least: int = 1) -> DataFrame:
    """Row numbers over the whole table in the order of a unique ``key``, without gathering it in one task."""
    from pyspark.sql import Window

    parts = df.repartitionByRange(F.col(key)).withColumn("range__id", F.spark_partition_id())
    local = parts.withColumn("range__rank", F.row_number().over(Window.partitionBy("range__id").orderBy(key)))
    sizes = parts.groupBy("range__id").count()
    # one row a range partition
    before = F.coalesce(F.sum("count").over(Window.orderBy("range__id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("range__id", before.alias("range__start"))
    return local.join(F.broadcast(starts), "range__id").withColumn(out, F.col("range__start") + F.col("range__rank") + (least - 1)).drop("range__id", "range__rank", "range__start")
