"""Schema operators: names, nulls, unions with promotion, evolution and checks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


FIELD_ID, NESTED_IDS = "parquet.field.id", "parquet.field.nested.ids"


def unique_names(names: Sequence[str]) -> list[str]:
    """Names that are not blank and differ also without regard to case: blanks become column_<position>, repeats get __2, __3, ..."""
    taken, out = set(), []
    for i, name in enumerate(names, 1):
        base = name if name.strip() else f"column_{i}"
        new, n = base, 1
        while new.lower() in taken:
            n += 1
            new = f"{base}__{n}"
        taken.add(new.lower())
        out.append(new)
    return out


def _rebuilt(kind: T.DataType, field, leaf) -> T.DataType:
    """A type with ``field`` applied to the fields of each struct and ``leaf`` to each other type."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _rebuilt(f.dataType, field, leaf), f.nullable, f.metadata) for f in field(kind.fields)])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_rebuilt(kind.elementType, field, leaf), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(_rebuilt(kind.keyType, field, leaf), _rebuilt(kind.valueType, field, leaf), kind.valueContainsNull)
    return leaf(kind)


def _renamed(fields: list[T.StructField]) -> list[T.StructField]:
    return [T.StructField(n, f.dataType, f.nullable, f.metadata) for n, f in zip(unique_names([f.name for f in fields]), fields, strict=True)]


def normalize_names(df: DataFrame) -> DataFrame:
    """Unique names at every struct level."""
    top = df.toDF(*unique_names(df.columns))
    return top.select(*[F.col(f"`{f.name}`").cast(_rebuilt(f.dataType, _renamed, lambda k: k)).alias(f.name) for f in top.schema.fields])


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Columns and nested fields without a type become text."""
    text = lambda k: T.StringType() if isinstance(k, T.NullType) else k
    return df.select(*[F.col(f"`{f.name}`").cast(_rebuilt(f.dataType, list, text)).alias(f.name) for f in df.schema.fields])


def assign_field_ids(schema: T.StructType) -> T.StructType:
    """The schema with depth-first field ids from 1 in the fields' metadata.

    Elements of arrays, entries of maps, and their keys and values have ids,
    too; those stand with the field that holds them, by their path from there.
    """
    count = 0

    def new() -> int:
        nonlocal count
        count += 1
        return count

    def fields(old: list[T.StructField]) -> list[T.StructField]:
        out = []
        for f in old:
            own, nested = new(), {}
            kind = inner(f.dataType, nested, ())
            metadata = {**f.metadata, FIELD_ID: own} | ({NESTED_IDS: nested} if nested else {})
            out.append(T.StructField(f.name, kind, f.nullable, metadata))
        return out

    def inner(kind: T.DataType, nested: dict, path: tuple[str, ...]) -> T.DataType:
        below = lambda kind, name: (nested.update({".".join((*path, name)): new()}), inner(kind, nested, (*path, name)))[1]
        if isinstance(kind, T.StructType):
            return T.StructType(fields(kind.fields))
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(below(kind.elementType, "element"), kind.containsNull)
        if isinstance(kind, T.MapType):
            nested[".".join((*path, "entries"))] = new()
            return T.MapType(below(kind.keyType, "key"), below(kind.valueType, "value"), kind.valueContainsNull)
        return kind

    return T.StructType(fields(schema.fields))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    """The Arrow schema with the field ids that ``assign_field_ids`` gave, so that Parquet files have them at every level."""

    def field(name: str, kind: T.DataType, nullable: bool, own: int | None, nested: dict, path: tuple[str, ...] = ()) -> pa.Field:
        below = lambda name, kind, nullable: field(name, kind, nullable, nested.get(".".join((*path, name))), nested, (*path, name))
        if isinstance(kind, T.StructType):
            arrow = pa.struct([top(f) for f in kind.fields])
        elif isinstance(kind, T.ArrayType):
            arrow = pa.list_(below("element", kind.elementType, kind.containsNull))
        elif isinstance(kind, T.MapType):
            arrow = pa.map_(below("key", kind.keyType, False), below("value", kind.valueType, kind.valueContainsNull))
        else:
            arrow = to_arrow_type(kind)
        return pa.field(name, arrow, nullable, None if own is None else {"PARQUET:field_id": str(own)})

    def top(f: T.StructField) -> pa.Field:
        return field(f.name, f.dataType, f.nullable, f.metadata.get(FIELD_ID), f.metadata.get(NESTED_IDS, {}))

    return pa.schema([top(f) for f in schema.fields])


def convert(c: Column, kind: T.DataType, to: T.DataType) -> Column:
    """A cast if Spark has one, nested values as JSON if text is wanted; else an error."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(to, T.StringType):
        return F.to_json(c) if isinstance(kind, nested) else c.cast(to)
    if isinstance(kind, nested) or isinstance(to, nested):
        if kind != to:
            raise TypeError(f"{kind.simpleString()} can't become {to.simpleString()}")
        return c
    return c.try_cast(to)


def union_schemas(frames: Sequence[DataFrame]) -> T.StructType:
    """All fields by exact name in the order of names, nullable; fields of differing types become text."""
    kinds: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds[f.name] = f.dataType if kinds.get(f.name, f.dataType) == f.dataType else T.StringType()
    return T.StructType([T.StructField(n, kinds[n], True) for n in sorted(kinds)])


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the schema's columns: missing ones null, extra ones left out."""
    have = {f.name: f.dataType for f in df.schema.fields}
    pick = lambda f: convert(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
    return df.select(*[pick(f).alias(f.name) for f in schema.fields])


def with_source_file(df: DataFrame, label: str) -> DataFrame:
    """A column __source_file with the label; __source_file_1 and so on if the name is taken."""
    name, n, taken = "__source_file", 0, {c.lower() for c in df.columns}
    while name in taken:
        n += 1
        name = f"__source_file_{n}"
    return df.withColumn(name, F.lit(label))


def source_name(c: Column) -> Column:
    """File name of a member label: after the last !/, without query, the last segment."""
    inner = F.element_at(F.split(c, "!/"), -1)
    return F.element_at(F.split(F.regexp_replace(inner, r"[?#].*$", ""), "/"), -1)


def check_geo(inputs: Sequence[dict | None]) -> None:
    """Plain and geographic inputs don't merge, and geographic metadata must agree but for its bounds."""
    found = [None if g is None else {k: v for k, v in g.items() if k != "bbox"} for g in inputs]
    if any((g is None) != (found[0] is None) for g in found):
        raise ValueError("plain and geographic tables can't be merged")
    if any(g != found[0] for g in found):
        raise ValueError("the tables have different geographic metadata")


def evolve(table: T.StructType, incoming: T.StructType) -> T.StructType:
    """The table's schema with the incoming columns it lacks; none is dropped or retyped."""
    have = {f.name.lower() for f in table.fields}
    return T.StructType([*table.fields, *[T.StructField(f.name, f.dataType, True) for f in incoming.fields if f.name.lower() not in have]])


def drop_empty_lists(df: DataFrame, keep: Sequence[str] = ("resources",)) -> DataFrame:
    """Without the array columns that are null or empty in every row."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and f.name not in keep]
    if not lists:
        return df
    used = df.agg(*[F.coalesce(F.max(F.size(F.col(f"`{c}`"))), F.lit(0)).alias(c) for c in lists]).first()
    return df.drop(*[c for c in lists if used[c] <= 0])


def list_shapes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, shapes) of columns of JSON arrays whose first elements are not all objects, all arrays or all scalars."""
    kind = lambda c: F.when(F.ltrim(F.get_json_object(c, "$[0]")).startswith("{"), "object").when(F.ltrim(F.get_json_object(c, "$[0]")).startswith("["), "array").when(F.get_json_object(c, "$[0]").isNotNull(), "scalar")
    rows = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), kind(F.col(f"`{c}`")).alias("shape")) for c in columns])))
    return rows.groupBy("column").agg(F.array_sort(F.collect_set("shape")).alias("shapes")).filter(F.size("shapes") > 1)


def strict_from_json(c: Column, schema: T.StructType) -> Column:
    """A JSON object as a struct; an unknown key is an error, and values are cast to the fields' types."""
    unknown = F.array_except(F.json_object_keys(c), F.array(*[F.lit(f.name) for f in schema.fields]))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = F.from_json(c, text)
    fields = F.struct(*[parsed[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return F.when(F.size(unknown) <= 0, fields).otherwise(F.raise_error(F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", "))).cast(schema))


COLLECTION_TYPES = {"VARCHAR": T.StringType(), "JSON": T.StringType(), "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "TIMESTAMPTZ": T.TimestampType()}


def ensure_collection(name: str, columns: dict[str, str]) -> T.StructType:
    """Schema of a declared collection, or an error that says what is wrong with the declaration."""
    if not re.fullmatch("[a-z][a-z0-9_]*", name) or name.startswith("catalog_"):
        raise ValueError(f"not a collection name: {name}")
    if columns.get("source_id") != "VARCHAR":
        raise ValueError("source_id must be a required text")
    for column, kind in columns.items():
        if kind not in COLLECTION_TYPES or not re.fullmatch("[a-z][a-z0-9_]*", column):
            raise ValueError(f"not a column: {column} {kind}")
    return T.StructType([T.StructField(c, COLLECTION_TYPES[k], c != "source_id") for c, k in columns.items()])


def merge_children(children: Sequence[tuple[str, DataFrame]], tabular: bool = True, geo: Sequence[dict | None] = ()) -> DataFrame:
    """One table of all children (label, rows), under the union of their schemas.

    Tables get the label of each row's file; other kinds have their ``name``
    replaced by it.  No rows at all is an error.
    """
    if not children:
        raise ValueError("there are no children")
    if geo:
        check_geo(geo)
    labelled = [with_source_file(df, label) if tabular else df.withColumn("name", source_name(F.lit(label))) for label, df in children]
    schema = union_schemas(labelled)
    merged = reduce(DataFrame.unionByName, [as_schema(df, schema) for df in labelled])
    if merged.isEmpty():
        raise ValueError("the children have no rows")
    return merged
