"""Streams over restarts: offsets, order by key, writers by name and checkpoint, and state that stays small."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lakewright.plans.manifests import Manifests
from lakewright.plans.state import StateTable
from lakewright.sources import messages as M
from lakewright.streaming import jobs as J

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def run(stream, out, checkpoint):
    query = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def messages(spark, rows):
    return spark.createDataFrame([(k, json.dumps({"n": n}), n) for k, n in rows], "key string, value string, n long")


def test_a_stopped_stream_goes_on_at_its_offset(spark, tmp_path):
    path, wanted = str(tmp_path / "log"), []
    for i in range(4):
        rows = [(k, 10 * i + j) for k in ("a", "b", None, "é") for j in range(3)]
        wanted += [(k, n) for k, n in rows]
        M.write_messages(messages(spark, rows), path, "n")
        run(M.read_messages(spark, path, "n long", stream=True), tmp_path / "out", tmp_path / "check")
        got = spark.read.parquet(str(tmp_path / "out")).collect()
        assert sorted((str(r["key"]), r["n"]) for r in got) == sorted((str(k), n) for k, n in wanted)
    for key in ("a", "b", None, "é"):
        mine = sorted((r["partition"], r["offset"], r["n"]) for r in got if r["key"] == key)
        assert len({p for p, _, _ in mine}) == 1 and [n for _, _, n in mine] == sorted(n for _, _, n in mine)
    places = [(r["partition"], r["offset"]) for r in got]
    assert len(set(places)) == len(places)
    again = M.read_messages(spark, path, "n long").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_offsets_bound_a_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    assert M.read_messages(spark, path, "n long").collect() == []
    log = M.MessageLog(spark, path, 1)
    for i in range(3):
        log.append(messages(spark, [("k", 10 * i + j) for j in range(5)]), "n")
    read = lambda **k: sorted((r["offset"], r["n"]) for r in M.read_messages(spark, path, "n long", **k).collect())
    assert read(start={0: 3}, end={0: 7}) == [(3, 3), (4, 4), (5, 10), (6, 11)]
    assert [o for o, _ in read()] == list(range(15)) and read(start={0: 15}) == []


def test_the_sink_writes_each_message_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda: spark.readStream.schema("key string, value string, n long").parquet(str(tmp_path / "in"))
    for i in range(3):
        messages(spark, [("a", 2 * i), ("a", 2 * i + 1), ("b", i)]).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):
            J.write_stream(rows(), path, str(tmp_path / "check"), "n").awaitTermination()
    got = M.read_messages(spark, path, "n long").collect()
    assert [r["n"] for r in sorted(got, key=lambda r: r["offset"]) if r["key"] == "a"] == list(range(6)) and len(got) == 9
    with pytest.raises(Exception, match="another checkpoint"):
        J.write_stream(rows(), path, str(tmp_path / "check2"), "n").awaitTermination()
    log = M.MessageLog(spark, path)
    assert log.append(messages(spark, [("a", 9)]), "n", ("w", 0)) and not log.append(messages(spark, [("a", 9)]), "n", ("w", 0))
    with pytest.raises(ValueError, match="after 0"):
        log.append(messages(spark, [("a", 9)]), "n", ("w", 2))
    # an append that was written but not committed is not read
    messages(spark, [("z", 1)]).withColumn("number", F.lit(0)).write.parquet(f"{path}/segments/lost/partition=0")
    assert M.read_messages(spark, path, "n long").count() == 10


SYNCS = "id long, instance_id long, status string, count int, error string"


def results(spark, folder, ids):
    spark.createDataFrame([(i, True, None, 7) for i in ids], "sync_id long, success boolean, error string, count int").write.mode("append").parquet(folder)
    return spark.readStream.schema("sync_id long, success boolean, error string, count int").parquet(folder)


def test_two_streams_and_a_new_checkpoint(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), SYNCS)
    table.update(lambda _: spark.createDataFrame([(i, 1, "running", 0, None) for i in range(6)], SYNCS))
    done = lambda: {r["id"] for r in table.read().filter("status = 'completed'").collect()}
    start = lambda name, ids, check=None: J.sync_state_stream(results(spark, str(tmp_path / name), ids), table, str(tmp_path / (check or f"{name}-check")), name).awaitTermination()
    start("one", [0, 1])
    start("two", [2])
    assert done() == {0, 1, 2}
    start("one", [3])
    assert done() == {0, 1, 2, 3}
    with pytest.raises(Exception, match="name of its own"):
        start("one", [4], "fresh-check")
    assert done() == {0, 1, 2, 3}


def test_updates_are_numbered_without_gaps(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), "n long")
    add = lambda n: lambda old: old.union(spark.range(n, n + 1))
    table.update(add(0), ("w", 0))
    table.update(add(0), ("w", 0))
    with pytest.raises(ValueError, match="after 0"):
        table.update(add(2), ("w", 2))
    table.update(add(1), ("w", 1))
    table.update(add(9), ("v", 0))
    assert sorted(r["n"] for r in table.read().collect()) == [0, 1, 9]
    assert Manifests(spark, table.root).newest() == 3


@pytest.mark.parametrize("kind", ["jobs", "children", "duplicates"])
def test_state_stays_flat_over_many_messages(spark, tmp_path, kind):
    """Ten times the messages over ten times the days leave the state of the last days."""
    sizes = []
    for day in range(20):
        ts = START + datetime.timedelta(days=day)
        rows = [(100 * day + i, ts, i % 5, f"{day}-{i}", "PENDING", f"{day}-{i}", 0, 2) for i in range(40)]
        df = spark.createDataFrame(rows, "event_id long, ts timestamp, resource_id long, job_id string, status string, parent_job_id string, child_index int, total_child_count int")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        stream = {"jobs": lambda s: J.job_state_stream(s, "2 days"), "children": lambda s: J.child_completion_stream(s, "2 days"), "duplicates": lambda s: J.deduplicated(s, watermark="2 days")}[kind](source)
        if day % 4 == 3:
            query = run(stream, tmp_path / "out", tmp_path / "check")
            sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    # four days come at once, and at most two more are remembered
    assert max(sizes) <= 40 * 8 and max(sizes[-2:]) <= max(sizes[:2]) + 40 * 3, sizes


def test_a_forgotten_job_begins_anew(spark, tmp_path):
    def send(day, event, status):
        spark.createDataFrame([(event, START + datetime.timedelta(days=day), 1, "j", status)], "event_id long, ts timestamp, resource_id long, job_id string, status string").write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("event_id long, ts timestamp, resource_id long, job_id string, status string").parquet(str(tmp_path / "in"))
        run(J.job_state_stream(source, "3 days"), tmp_path / "out", tmp_path / "check")

    send(0, 1, "PENDING")
    send(1, 2, "SUCCESS")
    send(2, 3, "SUCCESS")  # it is over
    send(30, 4, "PENDING")  # known, and the time goes on
    send(60, 5, "PROCESSING")
    got = {(r["event_id"], r["status"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {(1, "pending"), (2, "completed")} <= got and 3 not in {e for e, _ in got}


def test_keys_share_a_call_and_each_has_its_state(spark, tmp_path, monkeypatch):
    """More jobs and parents than buckets, over three micro-batches; a bucket's state holds many keys."""
    monkeypatch.setattr(J, "BUCKETS", 8)
    schema = "event_id long, ts timestamp, resource_id long, job_id string, status string, parent_job_id long, child_index int, total_child_count int"
    for batch, status in enumerate(("PENDING", "PROCESSING", "SUCCESS")):
        rows = [(1000 * batch + i, START + datetime.timedelta(days=batch), None if i < 3 else i % 5, str(i), "FAILED" if batch == 1 and i % 7 == 0 else status, i, batch, 2) for i in range(300)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        children = source().withColumn("status", F.when(F.col("status") == "FAILED", "FAILED").otherwise("SUCCESS"))
        states = [run(f, tmp_path / f"out-{n}", tmp_path / f"check-{n}").lastProgress["stateOperators"][0]["numRowsTotal"] for n, f in (("jobs", J.job_state_stream(source())), ("kept", J.job_state_stream(source(), "9 days")), ("children", J.child_completion_stream(children)))]
        assert states == [8, 8, 8]
    wanted = sorted((str(i), s) for i in range(300) for s in (("pending", "failed") if i % 7 == 0 else ("pending", "processing", "completed")))
    for name in ("jobs", "kept"):
        got = spark.read.parquet(str(tmp_path / f"out-{name}")).collect()
        assert sorted((r["job_id"], r["status"]) for r in got) == wanted
        assert all(r["resource_id"] == (None if int(r["job_id"]) < 3 else int(r["job_id"]) % 5) for r in got)
    got = spark.read.parquet(str(tmp_path / "out-children")).collect()
    assert sorted(map(tuple, got)) == [(i, "failed" if i % 7 == 0 else "completed") for i in range(300)]
