"""The data source, the stateful lifecycle and the sink, as streams against their tables."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import decode, envelope
from tidemark.queries import STREAM, USERS, wire
from tidemark.sources import change_stream
from tidemark.streaming import lifecycle, sink


@pytest.fixture(scope="module")
def log(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "changes")
    wire(spark, sf).write.parquet(path)
    return path


def test_batch_source_equals_scan(spark, log):
    change_stream.register(spark)
    t = spark.read.format("tidemark_changes").option("path", log).load()
    assert t.exceptAll(change_stream.scan(spark, log)).count() == 0 and t.count() == 1000
    lo, hi = t.agg(F.min("commit_us"), F.max("commit_us")).first()
    mid = (lo + hi) // 2
    some = spark.read.format("tidemark_changes").options(path=log, start_us=lo, end_us=mid, tokens=json.dumps(["p1", "p2"])).load()
    want = change_stream.scan(spark, log, lo, mid, ["p1", "p2"])
    assert some.count() == want.count() > 0 and some.exceptAll(want).count() == 0


def test_scan_pushes_down(spark, log):
    plan = change_stream.scan(spark, log, 5, None, ["p1"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(commit_us)" in plan and "GreaterThanOrEqual(commit_us,5)" in plan


def test_root_token_reads_records_without_one(spark, tmp_path):
    spark.createDataFrame([(None, 1, "{}"), ("a", 1, "{}")], "partition_token string, commit_us long, record string").write.parquet(str(tmp_path / "l"))
    assert change_stream.scan(spark, str(tmp_path / "l"), tokens=["Parent0"]).count() == 1
    change_stream.register(spark)
    assert spark.read.format("tidemark_changes").options(path=str(tmp_path / "l"), tokens='["Parent0"]').load().count() == 1


LOG = "partition_token string, commit_us long, record string"


def test_late_records_of_a_partition_behind_another_are_read(spark, tmp_path):
    """Positions are kept by partition: what p1 brings after p2 went ahead arrives, also after a restart, and nothing arrives twice."""
    change_stream.register(spark)
    path, out, cp = (str(tmp_path / n) for n in ("l", "o", "c"))

    def batch(*rows):
        """Append rows, restart the query from its checkpoint: all records so far, and all heartbeats."""
        if rows:
            spark.createDataFrame([(p, t, json.dumps({"n": t})) for p, t in rows], LOG).coalesce(1).write.mode("append").parquet(path)
        q = spark.readStream.format("tidemark_changes").options(path=path, max_rows=1).load().writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out)
        q.awaitTermination(120)
        assert q.exception() is None
        got = sorted(((r["partition_token"], r["commit_us"], "heartbeat" in r["record"]) for r in spark.read.schema(LOG).parquet(out).collect()), key=str)
        return [r[:2] for r in got if not r[2]], [r[:2] for r in got if r[2]]

    assert batch(("p1", 100), ("p2", 300), (None, 50)) == ([("p1", 100), ("p2", 300), (None, 50)], [])
    want = [("p1", 100), ("p1", 200), ("p1", 400), ("p2", 300), ("p3", 10), (None, 50)], [("p2", 400), (None, 400)]
    assert batch(("p1", 200), ("p1", 400), ("p3", 10)) == want
    assert batch() == want  # nothing new: nothing more


def test_positions_by_statistics_and_by_columns_agree(spark, tmp_path):
    rows = [(f"p{i % 3}", i, "{}") for i in range(300)] + [(None, 7, "{}")]
    t = spark.createDataFrame(rows, LOG)
    t.repartition(4, "partition_token").write.parquet(str(tmp_path / "a"))
    t.coalesce(1).write.parquet(str(tmp_path / "b"))
    want = {"p0": 297, "p1": 298, "p2": 299, "Parent0": 7}
    for name in "ab":
        r = change_stream.ChangeStreamReader({"path": str(tmp_path / name)})
        assert r.latestOffset() == {"at": want} == r.latestOffset()
        assert change_stream.ChangeStreamReader({"path": str(tmp_path / name), "end_us": "100", "tokens": '["p1", "Parent0"]'}).latestOffset() == {"at": {"p1": 100, "Parent0": 7}}


def test_stream_to_sink_equals_batch(spark, log, tmp_path):
    change_stream.register(spark)
    last = change_stream.scan(spark, log).agg(F.max("commit_us")).first()[0]
    stream = spark.readStream.format("tidemark_changes").options(path=log, end_us=last, max_rows=100000).load()
    make = lambda t: envelope.envelope(envelope.explode_mods(decode.decode_json(t)), USERS, ["user_id"], STREAM).select("topic", "key", "op", "before", "after", "ts_us")
    q = sink.run(make(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert q.exception() is None
    got = sink.read(spark, str(tmp_path / "out")).select("topic", "key", "op", "before", "after", "ts_us")
    want = make(change_stream.scan(spark, log))
    assert got.count() == want.count() == 1000 and want.exceptAll(got).count() == 0


EVENTS = "token string, seq long, kind string, uid string, at_us long"


@pytest.mark.parametrize(
    ("events", "want"),
    [
        ([("running", None), ("record", "a"), ("record", "b"), ("finish", None), ("ack", "a"), ("ack", "b")], 4),
        ([("running", None), ("record", "a"), ("ack", "a"), ("finish", None)], 4),
        ([("running", None), ("finish", None)], 4),
        ([("running", None), ("record", "a"), ("record", "b"), ("finish", None), ("ack", "a")], 3),
        ([("running", None), ("record", "a"), ("record", "b"), ("finish", None), ("ack", "b")], 4),
        ([("running", None), ("error", None)], 1),
        ([("created", None)], 0),
    ],
)
def test_finish_waits_for_the_last_ack(events, want):
    state = (0, None, None, False, 0)
    for i, (kind, uid) in enumerate(events):
        state = lifecycle.step(state, kind, uid, i)
    assert state[0] == want


def test_stateful_stream_equals_batch(spark, tmp_path):
    kinds = ["created", "ready", "scheduled", "running", "record", "record", "finish", "ack", "ack"]
    data = [(f"n{k}", i, kind, f"{i:04d}" if kind == "record" else f"{i - 3:04d}" if kind == "ack" else None, 10 * i + k) for k in range(6) for i, kind in enumerate(kinds) if not (k == 3 and i > 6)]
    table = spark.createDataFrame(data, EVENTS)
    half = str(tmp_path / "in")
    table.where("seq < 5").coalesce(1).write.parquet(half)
    table.where("seq >= 5").coalesce(1).write.mode("append").parquet(half)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(half)
    q = lifecycle.lifecycle(stream).writeStream.format("memory").queryName("lives").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    last = {r["token"]: r["state"] for r in spark.table("lives").groupBy("token").agg(F.max_by("state", "at_us").alias("state")).collect()}
    want = {r["token"]: r["state"] for r in lifecycle.lifecycle_batch(table).collect()}
    assert last == want and want["n3"] == 3 and want["n0"] == 4


def test_overdue(spark):
    t = spark.createDataFrame([("a", 0), ("b", 900_000_000)], "token string, since_us long")
    assert [r["token"] for r in lifecycle.overdue(t, 1_000_000_000).collect()] == ["a"]


def test_watermark_batches(spark, tmp_path):
    c = lambda: spark.createDataFrame([("t", "owned", "a", 3, 9, None, None)], "task_uid string, kind string, token string, state_ord long, start_us long, finished_us long, assignee string")
    o = lambda: spark.createDataFrame([("a", 12)], "token string, offset_us long")
    w = sink.watermark_batch(c, o, str(tmp_path / "w"))
    w(spark.range(1), 0)
    w(spark.range(1), 0)
    assert [r["low_watermark_us"] for r in spark.read.parquet(str(tmp_path / "w" / "batch=*")).collect()] == [12]


def test_stamps_and_overload_on_a_timer(spark, tmp_path):
    kind = "task_uid string, kind string, token string, state_ord long, start_us long, finished_us long, assignee string"
    rows = [("a", "owned", f"p{i}", 3, 9_000_000 + i, None, None) for i in range(9)] + [("b", "owned", "q", 3, 9_500_000, None, None), ("c", "owned", "r", 4, 1, 2, None)]
    claims = lambda: spark.createDataFrame(rows, kind)
    offsets = lambda: spark.createDataFrame([("p0", 9_700_000)], "token string, offset_us long")
    tables, off = spark.createDataFrame([("users",), ("audit",)], "table_name string"), [False]
    write = sink.stamp_batch(claims, offsets, tables, 2, STREAM, str(tmp_path / "s"), lambda: off[0])
    write(tables, 0)
    off[0] = True
    write(tables, 1)
    got = spark.read.parquet(str(tmp_path / "s" / "batch=*")).collect()
    assert len(got) == 4 and {r["source"]["low_watermark"] for r in got} == {9000} and {r["op"] for r in got} == {"m"}
    with pytest.raises(RuntimeError, match="a has 9 partitions"):
        sink.overload_check(claims, "a", 2)(tables, 0)
    assert sink.overload_check(claims, "b", 2)(tables, 0) is None
