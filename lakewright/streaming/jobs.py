"""Streams of job messages: keyed state by resource, completion of parents, syncs, and duplicate removal."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..plans.state import StateTable
from ..sources.messages import MessageLog

TERMINAL = {"SUCCESS": "completed", "FAILED": "failed", "DELETED": "deleted"}


def deduplicated(stream: DataFrame, key: str = "event_id", watermark: str | None = None) -> DataFrame:
    """Each message once; with a watermark on ts the memory of past keys is bounded."""
    if watermark is None:
        return stream.dropDuplicates([key])
    timed = stream.withColumn("event__time", F.col("ts").cast("timestamp")).withWatermark("event__time", watermark)
    return timed.dropDuplicatesWithinWatermark([key]).drop("event__time")


def applied(job: dict | None, status: str) -> dict | None:
    """State of a job after a message; None if the message changes nothing.

    PENDING begins a job once, PROCESSING starts it or opens it again, and a
    terminal message counts for a job that is begun and not over.
    """
    if status == "PENDING":
        return None if job else {"status": "pending"}
    if not job:
        return None
    if status == "PROCESSING":
        return {"status": "processing"}
    if status in TERMINAL and job["status"] not in TERMINAL.values():
        return {"status": TERMINAL[status]}
    return None


def _memory(stream: DataFrame, retention: str | None) -> tuple[DataFrame, int]:
    """The stream with its time, a watermark on it, and the milliseconds for which a key is remembered; 0 without a retention."""
    if retention is None:
        return stream, 0
    span = stream.sparkSession.sql(f"SELECT unix_millis(timestamp'1970-01-01 00:00:00Z' + INTERVAL {retention})").first()[0]
    time = F.col("ts").cast("timestamp")
    return stream.withColumn("event__time", time).withColumn("event__ms", F.unix_millis(time)).withWatermark("event__time", f"{span} milliseconds"), span


#: Buckets that jobs and parents are dealt to.  A bucket's keys share one state and one call, as a call a key would cost more than its messages.
BUCKETS = 1 << 14


def _dealt(stream: DataFrame, *keys: str):
    """The stream with the text of its key, grouped by bucket."""
    key = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    return stream.withColumn("state__key", key).withColumn("state__bucket", F.pmod(F.xxhash64("state__key"), F.lit(BUCKETS))).groupBy("state__bucket")


def _held(state) -> dict[str, list]:
    """A bucket's keys, each with what is known of it and the time until which it is remembered."""
    return json.loads(state.get[0]) if state.exists else {}


def _remember(state, held: dict[str, list], rows: pd.DataFrame | None, milliseconds: int) -> None:
    """Keep a bucket's keys; if ``milliseconds`` is not 0, each until so long after its newest message."""
    if milliseconds:
        now = state.getCurrentWatermarkMs()
        if rows is not None:
            for key, newest in rows.groupby("state__key")["event__ms"].max().items():
                if key in held:
                    held[key][-1] = max(int(newest) + milliseconds, now + 1)
        for key in [k for k, v in held.items() if v[-1] < now]:
            del held[key]
    if held:
        state.update((json.dumps(held),))
        if milliseconds:
            state.setTimeoutTimestamp(max(min(v[-1] for v in held.values()), now + 1))
    elif state.exists:
        state.remove()


def job_state_stream(stream: DataFrame, retention: str | None = None) -> DataFrame:
    """Transitions (resource_id, job_id, status, event_id, ts) of messages (event_id, ts, resource_id, job_id, status).

    Each job has a state of its own, its status, so a resource with very many
    jobs is spread over tasks; jobs are kept in BUCKETS buckets, and a message
    rewrites its bucket.  Messages of a micro-batch are applied in time order;
    late ones meet the guard of a job that is over.  With a ``retention``, such
    as '30 days', a job is forgotten when time has gone on for so long after its
    last message, so the state holds the jobs of that time only; without one it
    holds all, as a job that is over can be opened again.
    """
    stream, kept = _memory(stream, retention)
    columns = ["resource_id", "job_id", "status", "event_id", "ts"]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = _held(state)
        if state.hasTimedOut:
            _remember(state, held, None, kept)
            return
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        at, became = [], []
        for i, (job, status) in enumerate(zip(rows["state__key"], rows["status"], strict=True)):
            new = applied({"status": held[job][0]} if job in held else None, status)
            if new:
                held[job] = [new["status"], 0 if job not in held else held[job][1]]
                at.append(i)
                became.append(new["status"])
        _remember(state, held, rows, kept)
        if at:
            yield rows.iloc[at].assign(status=became)[columns]

    kinds = dict(stream.dtypes)
    output = f"resource_id {kinds['resource_id']}, job_id string, status string, event_id {kinds['event_id']}, ts {kinds['ts']}"
    timeout = GroupStateTimeout.EventTimeTimeout if kept else GroupStateTimeout.NoTimeout
    return _dealt(stream, "resource_id", "job_id").applyInPandasWithState(run, output, "held string", "append", timeout)


def child_completion_stream(stream: DataFrame, retention: str | None = None) -> DataFrame:
    """(parent_job_id, status) once a parent is decided: failed by its first failed child, completed when all indexes are there.

    Messages have parent_job_id, child_index, status and total_child_count.  A
    micro-batch counts as a whole, in any order: if it holds a failure, the
    parent fails.  What comes after the verdict changes nothing, and the
    indexes of a parent that is decided are forgotten.  With a ``retention``
    messages have a ts, too, and a parent is forgotten when time has gone on
    for so long after its last one.
    """
    stream, kept = _memory(stream, retention)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = _held(state)
        if state.hasTimedOut:
            _remember(state, held, None, kept)
            return
        rows = pd.concat(list(frames))
        # of a parent: its indexes, None once it is over
        news: dict[str, tuple[int, set, set, list]] = {}
        for i, (parent, child, status, total) in enumerate(zip(rows["state__key"], rows["child_index"], rows["status"], rows["total_child_count"], strict=True)):
            if parent in held and held[parent][0] is None:
                continue
            if parent not in news:
                news[parent] = (i, set(held[parent][0]) if parent in held else set(), set(), [])
            _, done, failures, totals = news[parent]
            if status == "FAILED":
                failures.add(i)
            elif status == "SUCCESS":
                done.add(int(child))
            if not pd.isna(total):
                totals.append(int(total))
        at, verdicts = [], []
        for parent, (i, done, failures, totals) in news.items():
            verdict = "failed" if failures else "completed" if len(done) >= min(totals) else None
            held[parent] = [None if verdict else sorted(done), held[parent][1] if parent in held else 0]
            if verdict:
                at.append(i)
                verdicts.append(verdict)
        _remember(state, held, rows, kept)
        if at:
            yield rows.iloc[at][["parent_job_id"]].assign(status=verdicts)

    output = f"parent_job_id {dict(stream.dtypes)['parent_job_id']}, status string"
    return _dealt(stream, "parent_job_id").applyInPandasWithState(run, output, "held string", "append", GroupStateTimeout.EventTimeTimeout if kept else GroupStateTimeout.NoTimeout)


def checkpoint_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to; it stays the same over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def sync_state_stream(results: DataFrame, table: StateTable, checkpoint: str, name: str = "syncs"):
    """Apply sync results to a state table, one version a micro-batch; a batch that is sent again changes nothing.

    Streams into one table have a name each.  The table knows the checkpoint of
    a name, and refuses another one, whose batches would be taken for those
    that it has.
    """
    from ..operators.ledger import apply_sync_results

    def batch(df: DataFrame, number: int) -> None:
        table.update(lambda syncs: apply_sync_results(syncs, df), once=(name, number), identity=checkpoint_identity(df.sparkSession, checkpoint))

    return results.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_stream(df: DataFrame, path: str, checkpoint: str, order: str | None = None, name: str = "messages"):
    """Messages (key, value, ...) of a stream, appended to a message log; each once, by the checkpoint, and in order by key."""

    def batch(rows: DataFrame, number: int) -> None:
        MessageLog(rows.sparkSession, path).append(rows, order, once=(name, number), identity=checkpoint_identity(rows.sparkSession, checkpoint))

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
