"""Job, result and sync messages as JSON: a log of keyed messages in partitions with offsets, read in batches and streams."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.window import Window

from ..plans.folders import file_system
from ..plans.manifests import Manifests

JOB_RESULT = "event_id long, ts timestamp, resource_id string, job_id string, status string"
PARTITIONS = 16
RECORD = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string())])


class MessageLog:
    """Keyed messages below ``root``.

    Messages of a key are in one partition, in the order in which they came.
    An append is a segment of Parquet files; the manifest that publishes it
    holds the first and the next offset of each partition, so readers see whole
    appends, and where a reader stands is one number a partition.
    """

    def __init__(self, spark: SparkSession, root: str, partitions: int = PARTITIONS):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, self.root)
        base = self.manifests.newest()
        self.partitions = len(self.manifests.read(base)["ends"]) if base else partitions

    def append(self, messages: DataFrame, order: str | None = None, once: tuple[str, int] | None = None, identity: str | None = None) -> bool:
        """Add messages (key, value, ...), those of a key in the order of a column; False if ``once``, a writer's name and number, was added before.

        Numbers go up by one, and a name belongs to one identity, as in
        ``StateTable.update``.  A null key is a key.
        """
        base = self.manifests.newest()
        held = self.manifests.read(base) if base else {"ends": [0] * self.partitions, "done": {}}
        done = held["done"]
        if once is not None:
            known, last = done.get(once[0], [identity, -1])
            if known != identity:
                raise ValueError(f"{once[0]} writes to {self.root} from another checkpoint; a second stream needs a name of its own")
            if once[1] <= last:
                return False
            if once[1] > last + 1 and (once[0] in done or identity is not None):
                raise ValueError(f"{once[0]} sends {once[1]} to {self.root} after {last}")
            done = {**done, once[0]: [identity, once[1]]}
        segment = f"segments/{base + 1:012d}-{uuid.uuid4().hex}"
        place = F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit(""))), F.lit(self.partitions)).cast("int")
        rows = messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), (F.col(order) if order else F.lit(0)).alias("order"), place.alias("partition"))
        numbered = rows.withColumn("number", F.row_number().over(Window.partitionBy("partition").orderBy("order", "key", "value")) - 1)
        numbered.select("partition", F.col("number").cast("long").alias("number"), "key", "value").write.partitionBy("partition").parquet(f"{self.root}/{segment}")
        written = self.spark.read.schema("number long, partition int").parquet(f"{self.root}/{segment}")
        counts = {r["partition"]: r["n"] for r in written.groupBy("partition").agg(F.count("*").alias("n")).collect()}
        ends = [end + counts.get(p, 0) for p, end in enumerate(held["ends"])]
        self.manifests.commit(base, {"segment": segment, "starts": held["ends"], "ends": ends, "done": done})
        return True


class _Span(InputPartition):
    """Messages of one partition of a segment, from an offset up to another."""

    def __init__(self, folder: str, number: int, start: int, low: int, high: int):
        self.folder, self.number, self.start, self.low, self.high = folder, number, start, low, high


def _manifests(root: str) -> list[dict]:
    fs, path = file_system(root)
    found = fs.get_file_info(pafs.FileSelector(f"{path}/manifests", allow_not_found=True))
    names = sorted(f.path for f in found if f.base_name.endswith(".json") and f.base_name[0] != ".")
    out = []
    for name in names:
        with fs.open_input_stream(name) as file:
            out.append(json.loads(file.read()))
    return out


def _spans(root: str, start: dict, end: dict) -> list[_Span]:
    """Parts of the segments that lie from one place to another; a partition that a place lacks is at its start there, or at its end."""
    spans = []
    for manifest in _manifests(root):
        for number, (low, high) in enumerate(zip(manifest["starts"], manifest["ends"], strict=True)):
            first, last = max(low, start.get(str(number), 0)), min(high, end.get(str(number), high))
            if first < last:
                spans.append(_Span(f"{root}/{manifest['segment']}/partition={number}", number, low, first, last))
    return spans


def _read(span: _Span) -> Iterator[pa.RecordBatch]:
    fs, path = file_system(span.folder)
    low, high = span.low - span.start, span.high - span.start
    rows = ds.dataset(path, format="parquet", filesystem=fs)
    for batch in rows.to_batches(["number", "key", "value"], filter=(ds.field("number") >= low) & (ds.field("number") < high)):
        if batch.num_rows:
            offset = pc.add(batch.column(0), span.start)
            yield pa.RecordBatch.from_arrays([pa.array([span.number] * len(batch), pa.int32()), offset, batch.column(1), batch.column(2)], schema=RECORD)


class _LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.start, self.end = (json.loads(options.get(name, "{}")) for name in ("startingoffsets", "endingoffsets"))

    def partitions(self) -> list[_Span]:
        return _spans(self.root, self.start, self.end) or [_Span("", 0, 0, 0, 0)]

    def read(self, partition: _Span) -> Iterator[pa.RecordBatch]:
        yield from _read(partition) if partition.folder else iter(())


class _LogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.start = json.loads(options.get("startingoffsets", "{}"))

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        held = _manifests(self.root)
        return {str(p): end for p, end in enumerate(held[-1]["ends"])} if held else {}

    def partitions(self, start: dict, end: dict) -> list[_Span]:
        return _spans(self.root, start, end)

    def read(self, partition: _Span) -> Iterator[pa.RecordBatch]:
        yield from _read(partition)


class MessageSource(DataSource):
    """``spark.read.format("message_log")`` and ``readStream``: (partition, offset, key, value) of the log at ``path``.

    ``startingOffsets`` and, for a batch, ``endingOffsets`` are JSON objects of
    offsets by partition.  A stream's checkpoint holds where it stands.
    """

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "partition int, offset long, key string, value string"

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> _LogReader:
        return _LogReader(self._options())

    def streamReader(self, schema) -> _LogStream:
        return _LogStream(self._options())


def read_messages(spark: SparkSession, path: str, schema: str = JOB_RESULT, stream: bool = False, start: dict | None = None, end: dict | None = None) -> DataFrame:
    """(partition, offset, key, and the fields of the JSON value) of a message log; as a stream, appends are read as they come."""
    spark.dataSource.register(MessageSource)
    reader = (spark.readStream if stream else spark.read).format("message_log").option("path", path)
    for name, offsets in (("startingOffsets", start), ("endingOffsets", end)):
        if offsets:
            reader = reader.option(name, json.dumps({str(p): n for p, n in offsets.items()}))
    return reader.load().select("partition", "offset", "key", F.from_json("value", schema).alias("m")).select("partition", "offset", "key", "m.*")


def write_messages(df: DataFrame, path: str, order: str | None = None) -> None:
    """Append messages (key, value, ...) to a log."""
    MessageLog(df.sparkSession, path).append(df, order)
