"""Bodies made of the tables, for queries over readers: feeds and archives as bytes."""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.folders import file_system
from ..sources import transit
from .base import Tables


def varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    if value < 128:
        return bytes((value,))
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def encoder(fields: dict) -> Callable[[dict], bytes]:
    """A function that gives the bytes of a message by its field table, with the tags of all fields made once."""
    plain = {"int": 0, "bool": 0, "float": 5, "double": 1}
    table = []
    for tag, (name, kind) in fields.items():
        many, one = (True, kind[0]) if isinstance(kind, list) else (False, kind)
        wire = 2 if isinstance(one, dict) else plain.get(one, 2)
        table.append((name, many, wire, varint(tag << 3 | wire), encoder(one) if isinstance(one, dict) else None))

    def run(message: dict) -> bytes:
        out = b""
        for name, many, wire, tag, inner in table:
            if (held := message.get(name)) is None:
                continue
            for value in held if many else (held,):
                if value is None:
                    continue
                if wire == 2:
                    body = inner(value) if inner else value.encode()
                    out += tag + varint(len(body)) + body
                else:
                    out += tag + (struct.pack("<d" if wire == 1 else "<f", value) if wire else varint(int(value)))
        return out

    return run


def encode(message: dict, fields: dict) -> bytes:
    """The bytes of a message by its field table; the inverse of ``transit.decode``."""
    return encoder(fields)(message)


def zipped(members: dict[str, str]) -> bytes:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in members.items():
            out.writestr(zipfile.ZipInfo(name), text, zipfile.ZIP_DEFLATED)
    return packed.getvalue()


def pack_archives(members: DataFrame, folder: str) -> str:
    """Write members (archive, member, text) as one ZIP file an archive below a folder; returns the folder."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        name = str(df["archive"].iloc[0])
        with fs.open_output_stream(f"{path}/{name}.zip") as out:
            out.write(zipped(dict(sorted(zip(df["member"], df["text"], strict=True)))))
        return pd.DataFrame({"archive": [name]})

    members.groupBy("archive").applyInPandas(run, "archive string").count()
    return folder


#: Kinds of resources by the last digit of a customer's key: format and file name.
RESOURCES = [("CSV", "x"), ("CSV", "x"), ("JSON", "datapackage.json"), ("geojson", "x"), ("GTFS-RT", "x"), ("log", "x"), ("PDF", "a.pdf"), ("ZIP", "x"), ("CSV", "x"), ("csv,json", "x")]


def resources(t: Tables) -> DataFrame:
    """Customers as resources of ten kinds; those whose key ends in 18 have a format that no reader takes."""
    k = (F.col("c_custkey") % 10).cast("int")
    pick = lambda i: F.get(F.array(*[F.lit(r[i]) for r in RESOURCES]), k)
    format_ = F.when(F.col("c_custkey") % 20 == 18, "xyz").otherwise(pick(0))
    return t.customer.select(F.col("c_custkey").alias("id"), format_.alias("format"), F.concat(F.lit("http://h/d/"), "c_custkey").alias("url"), pick(1).alias("file_name"), (k == 0).alias("datastore_active"))


def captures(t: Tables) -> DataFrame:
    """Bodies of the resources, made of each customer's orders."""
    orders = F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))))
    columns = ("o_orderkey", "o_orderstatus", "o_totalprice")
    lists = t.orders.groupBy("o_custkey").agg(orders.alias("orders")).select("o_custkey", *[F.col(f"orders.{c}").alias(c) for c in columns])

    def bodies(key: int, rows: list[tuple], feed: Callable[[dict], bytes]) -> list[tuple]:
        kind = key % 10
        one = lambda content, status=200: [(0, status, content if isinstance(content, bytes) else content.encode())]
        if kind == 0:
            page = lambda records: json.dumps({"fields": [{"id": "key"}, {"id": "status"}, {"id": "price"}], "records": records})
            return [(start, 200, page([list(r) for r in rows[start : start + 4]]).encode()) for start in range(0, len(rows) + 4, 4)]
        if kind == 1:
            return one("key;status;price\r\n" + "".join(f'{a};"{b}"" x";{c}\r\n' for a, b, c in rows))
        if kind == 2 and key % 20 == 12:
            return one(json.dumps([{"key": a, "none": None} for a, _, _ in rows]))
        if kind == 2:
            return one(json.dumps({"resources": [{"name": f"o{a}", "bytes": int(c)} for a, _, c in rows]}))
        if kind == 3:
            return one(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"key": a, "tags": [b], "price": c}, "geometry": {"type": "Point", "coordinates": [a, 1]}} for a, b, c in rows]}))
        if kind == 4:
            return one(feed({"header": {"gtfs_realtime_version": "2.0"}, "entity": [{"id": f"e{a}", "vehicle": {"timestamp": a}} for a, _, _ in rows]}))
        if kind == 5:
            return one("".join(f"<EV={a}>\n" for a, _, _ in rows))
        if kind == 6:
            return []
        if kind == 7:
            return one(zipped({f"{a}.csv": b for a, b, _ in rows}))
        if kind == 9:
            return one("key,status\n1,2\n3,4\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows[:1]))
        return one("gone", 404)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feed = encoder(transit.FEED)
        for df in frames:
            yield pd.DataFrame([(key, start, f"http://h/d/{key}", status, content) for key, *lists in zip(df["o_custkey"], *(df[c] for c in columns), strict=True) for start, status, content in bodies(int(key), list(zip(*(x.tolist() for x in lists), strict=True)), feed)], columns=["id", "start", "page_url", "status", "content"])

    return lists.mapInPandas(run, "id long, start long, page_url string, status int, content binary")
