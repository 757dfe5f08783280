"""Operators on small tables: the cases that the queries do not reach."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.types import ColumnType
from tidemark.operators import decode, envelope, lineage, metrics, ownership, rebalance, schema, syncfold, watermark


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_unknown_kind_raises(spark):
    t = spark.createDataFrame([("p", '{"other":1}')], "partition_token string, record string")
    with pytest.raises(PySparkException, match="no known record kind"):
        decode.decode_json(t).collect()
    assert decode.decode_json(t, strict=False).count() == 1


def test_missing_field_raises(spark):
    t = spark.createDataFrame([("p", '{"data_change_record":{"table_name":"t"}}')], "partition_token string, record string")
    with pytest.raises(PySparkException, match="data record without"):
        decode.decode_json(t).collect()


def test_dialects():
    assert decode.wire_dialect("google", True) == "nested" and decode.wire_dialect("postgres") == "json"
    for bad in (("postgres", True), ("oracle", False)):
        with pytest.raises(ValueError):
            decode.wire_dialect(*bad)


def test_read_operation_raises(spark):
    with pytest.raises(PySparkException, match="no operation"):
        spark.range(1).select(envelope.operation(F.lit("READ"))).collect()


def test_source_needs_names():
    with pytest.raises(ValueError):
        envelope.source_info({"project_id": "p"})


def test_keys_win_and_null_stays_null(spark):
    rec = {"data_change_record": {"commit_timestamp": "2024-01-01T00:00:00Z", "record_sequence": "007", "server_transaction_id": "t", "table_name": "a", "mod_type": "UPDATE", "value_capture_type": "NEW_ROW",
           "mods": [{"keys": {"id": "1"}, "new_values": {"id": "9", "v": None}, "old_values": {"v": "x"}}]}}
    r = decode.decode_json(spark.createDataFrame([("p", json.dumps(rec))], "partition_token string, record string"))
    e = envelope.envelope(envelope.explode_mods(r, first=1), {"id": ColumnType("INT64"), "v": ColumnType("INT64")}, ["id"], {k: "x" for k in ("project_id", "instance_id", "database_id", "change_stream_name")}).first()
    assert (e["before"]["id"], e["before"]["v"], e["after"]["id"], e["after"]["v"]) == (1, 0, 1, None)
    assert e["source"]["record_sequence"] == 7 and e["source"]["mod_number"] == 1 and e["offset"]["offset"] == "2024-01-01T00:00:00Z"


def test_headers_and_metadata(spark):
    r = spark.range(1).select(envelope.headers(F.lit("aaaaaaaa"), F.lit(5), None, F.lit(None)).alias("h")).first()["h"]
    assert r == {"recordUid": "aaaaaaaa", "emitTimestamp": "5"}
    assert spark.range(1).select(envelope.event_metadata(F.struct(F.lit(1).alias("x")).cast("struct<ts_ms:long>").alias("s")["ts_ms"].isNull().alias("n") if False else F.struct(F.lit(7).alias("ts_ms"), F.lit(3).alias("record_sequence"), F.lit("s").alias("change_stream_name"), F.lit("t").alias("table"), F.lit("tx").alias("server_transaction_id")), F.lit(None)).alias("m")).first()["m"] is None


def test_heartbeats(spark):
    t = spark.createDataFrame([("p", '{"heartbeat_record":{"timestamp":"1970-01-01T00:00:01.5Z"}}')], "partition_token string, record string")
    h = envelope.heartbeats(decode.decode_json(t)).first()
    assert (h["key"]["partition_token"], h["value"]["ts_ms"], h["output_partition"]) == ("p", 1500, 0)


def test_table_filter(spark):
    t = spark.createDataFrame([("userAccount",), ("userInfo",)], "n string")
    keep = lambda **k: [r[0] for r in t.where(envelope.table_filter(F.col("n"), **k)).collect()]
    assert keep(include=".*Account") == ["userAccount"]
    assert keep(exclude=".*account") == ["userInfo"]
    assert keep(include="userInfo", exclude="userInfo") == ["userInfo"]
    assert len(keep()) == 2


CLAIM = "task_uid string, kind string, token string, state_ord long, start_us long, finished_us long, assignee string"


def claims(spark, *data):
    return spark.createDataFrame([(*d, *[None] * (7 - len(d))) for d in data], CLAIM)


def test_eligibility(spark):
    edges = spark.createDataFrame([("a", "r"), ("b", "x"), ("c", "r"), ("c", "f"), ("d", "f"), ("e", "f"), ("e", "gone")], "token string, parent string")
    c = claims(spark, ("t", "owned", "r", 3), ("t", "owned", "f", 4), *[("t", "owned", k, 0) for k in "abcdeg"])
    assert [r[0] for r in rows(lineage.eligible(c, edges).select("token"))] == ["b", "d", "g"]


def test_watermark_empty_and_regress(spark):
    none = claims(spark).where("false")
    off = spark.createDataFrame([("a", 5)], "token string, offset_us long")
    assert tuple(watermark.low_watermark(none, off, 77).first()) == (77, 0, 0)
    c = claims(spark, ("t", "owned", "a", 3, 9), ("t", "owned", "b", 4, 1), ("t", "shared", "z", 4, 7))
    assert watermark.low_watermark(c, off).first()["low_watermark_us"] == 5
    assert watermark.low_watermark(claims(spark, ("t", "owned", "a", 3, 9), ("u", "owned", "a", 3, 9)), off).first()["low_watermark_us"] is None


def test_least_loaded_prefers_me(spark):
    t = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0), ("d", 0)], "task_uid string, load long")
    assert ownership.least_loaded(t, "d").first()["task_uid"] == "d"
    assert ownership.least_loaded(t).first()["task_uid"] == "c"


def test_statistics_golden(spark):
    t = spark.createDataFrame([(i, v) for i, v in enumerate([148, 197, 98, 47, 397, 10, 298])], "i int, v long")
    r = metrics.statistics(t, "v", "i").first()
    assert (r["min_value"], r["max_value"], r["avg_value"], r["last_value"], r["values"]) == (10, 397, 170.71428571428572, 298, 7)


@pytest.mark.parametrize(("args", "want"), [((0, 2, 2, 20, 10, 0), 5), ((5, 2, 2, 20, 10, 0), 5), ((5, 1, 2, 100, 300, 0), 100), ((10, 2, 2, 20, 4, 8), 5), ((3, 2, 2, 10, 1, 3), 2)])
def test_scale(args, want):
    assert metrics.scale(*args) == want


def test_merge_keeps_dropped_columns(spark):
    kind = "table_name string, column_name string, type_text string"
    old = spark.createDataFrame([("t", "id", "INT64"), ("t", "belka", "BYTES"), ("gone", "id", "INT64")], kind)
    new = spark.createDataFrame([("t", "id", "INT64"), ("t", "added", "DATE")], kind)
    assert [tuple(r)[:3] + (r["retained"],) for r in rows_of(schema.merge(old, new))] == [("t", "added", "DATE", False), ("t", "belka", "BYTES", True), ("t", "id", "INT64", False)]


def rows_of(df):
    return sorted(df.collect(), key=str)


def test_struct_types_and_cache():
    r = [dict(column_name="v", type_text="FLOAT64", ordinal=2, nullable=False, is_primary_key=False), dict(column_name="id", type_text="INT64", ordinal=1, nullable=False, is_primary_key=True)]
    key, value = schema.struct_types(r)
    assert key.names == ["id"] and not key["id"].nullable and value.names == ["id", "v"] and value["v"].nullable
    assert schema.struct_types(r[:1])[0] is None
    calls = []
    c = schema.SchemaCache(lambda t, v: calls.append((t, v)) or len(calls))
    assert c.of("t", 1) == c.of("t", 1) == 1
    c.reset()
    assert c.of("t", 1) == 2


def test_catalog_scans(spark):
    streams = spark.createDataFrame([("s1",)], "stream string")
    assert schema.stream_exists(streams, "S1", "postgres") and not schema.stream_exists(streams, "S1")
    options = spark.createDataFrame([("s1", "PARTITION_MODE", "mutable_key_range")], "stream string, option_name string, option_value string")
    assert schema.mutable_ranges(options, "s1") and not schema.mutable_ranges(options, "s2")
    cols = spark.createDataFrame([("public", "t", "c"), ("", "t", "d"), ("public", "u", "e")], "table_schema string, table_name string, column_name string")
    assert [r["column_name"] for r in schema.columns_scan(cols, ["t"], "postgres").collect()] == ["c"]


def test_fold_keeps_the_earlier_of_equal_times(spark):
    log = spark.createDataFrame([(1, "t", 5), (2, "t", 5), (3, "t", 4)], "log_offset long, task_uid string, state_ts long")
    assert syncfold.latest_states(log).first()["log_offset"] == 1


def shared_one_by_one(rows, leader, alive):
    """What equal sharing means: every token that nobody has any more goes to whoever has least at that moment."""
    alive = {*alive, leader}
    order = lambda r: (r["token"], r["state_ord"], r["task_uid"])
    gone, stay = sorted((r for r in rows if r["task_uid"] not in alive), key=order), sorted((r for r in rows if r["task_uid"] in alive), key=order)
    mine = {(r["kind"], r["token"]): (r["state_ord"], r["assignee"]) for r in stay if r["task_uid"] == leader}
    held = {t: {r["token"] for r in stay if (r["task_uid"] == t and r["kind"] == "owned" and r["state_ord"] < 4) or (r["kind"] == "shared" and r["assignee"] == t)} for t in alive}
    taken = {r["token"] for r in stay if r["kind"] == "owned" or r["assignee"] in alive}
    owned = {r["token"] for r in stay if r["kind"] == "owned"}
    for r in gone:
        if r["kind"] == "owned" and r["state_ord"] == 4 and r["token"] not in owned and ("owned", r["token"]) not in mine:
            mine["owned", r["token"]] = (4, None)
            taken.add(r["token"])
    for r in gone:
        if r["kind"] == "shared" and r["assignee"] in alive and r["token"] not in taken:
            mine[("owned", r["token"]) if r["assignee"] == leader else ("shared", r["token"])] = (r["state_ord"], None if r["assignee"] == leader else r["assignee"])
            held[r["assignee"]].add(r["token"])
            taken.add(r["token"])
    lost = [r for r in gone if r["kind"] == "shared"], [r for r in stay if r["kind"] == "shared" and r["assignee"] not in alive], [r for r in gone if r["kind"] == "owned" and r["state_ord"] < 4]
    for token in dict.fromkeys(r["token"] for part in lost for r in part):
        if token not in taken:
            t = min(alive, key=lambda t: (len(held[t]), t != leader, t))
            held[t].add(token)
            taken.add(token)
            mine.pop(("shared", token), None)
            mine["owned" if t == leader else "shared", token] = (0, None if t == leader else t)
    return {(k, t, *v) for (k, t), v in mine.items() if k == "owned" or ("owned", t) not in mine and v[1] in alive}


@pytest.mark.parametrize("seed", range(4))
def test_equal_sharing_gives_each_to_the_least_loaded(spark, seed):
    rng = random.Random(seed)
    tasks = [f"t{i}" for i in range(6)]
    alive = tasks[:3]
    data = [dict(task_uid=rng.choice(tasks), kind="owned", token=f"p{i}", state_ord=rng.randrange(5), assignee=None) for i in range(60)]
    data += [dict(task_uid=rng.choice(tasks), kind="shared", token=f"s{i}" if i % 3 else f"p{i}", state_ord=rng.randrange(2), assignee=rng.choice(tasks)) for i in range(20)]
    t = spark.createDataFrame([tuple(r[c] for c in rebalance.COLUMNS) for r in data], "task_uid string, kind string, token string, state_ord long, assignee string")
    out = rebalance.share_equally(t, "t0", alive).collect()
    assert len(out) == len({(r["kind"], r["token"]) for r in out}) and {r["task_uid"] for r in out} == {"t0"}
    assert {(r["kind"], r["token"], r["state_ord"], r["assignee"]) for r in out} == shared_one_by_one(data, "t0", alive)


def test_dealing_fills_the_lowest_first(spark):
    loads = spark.createDataFrame([("a", 9), ("b", 0), ("c", 3)], "task_uid string, load long")
    tokens = spark.createDataFrame([(f"p{i}", 0) for i in range(7)], "token string, class int")
    got = {r["token"]: r["assignee"] for r in ownership.dealt(tokens, loads, "c").collect()}
    assert [got[f"p{i}"] for i in range(7)] == ["b", "b", "b", "c", "b", "c", "b"]
    assert ownership.dealt(tokens.where("false"), loads, "c").count() == 0


def test_lineage_depth_on_cycles_and_long_chains(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("b", "c"), ("d", "a")], "token string, parent string")
    assert {r["token"]: r["depth"] for r in lineage.depths(e).collect()} == {"a": 0, "b": None, "c": None, "d": 1}


def test_record_columns_as_text(spark):
    t = spark.createDataFrame([("p", '{"heartbeat_record":{"timestamp":"1970-01-01T00:00:01Z"}}')], "partition_token string, record string")
    v = t.withColumn("record", F.parse_json("record"))
    assert decode.decode(t, "postgres").collect() == decode.decode(v, "postgres").collect()
    with pytest.raises(ValueError, match="no JSON text"):
        decode.decode_json(t.withColumn("record", F.lit(1)))
    null = t.withColumn("record", F.lit(None).cast("string"))
    assert decode.decode_json(null, strict=False).first()["record_type"] is None
    with pytest.raises(PySparkException, match="no known record kind"):
        decode.decode_json(null).collect()


def test_a_wrong_key_raises(spark):
    kind = "table_name string, column_name string, type_text string, is_primary_key boolean"
    a, b = (spark.createDataFrame([("t", "id", "INT64", k)], kind) for k in (True, False))
    with pytest.raises(PySparkException, match="primary key data is incorrect"):
        schema.validate(a, b).collect()
    assert schema.validate(a, a, a.where("false")).first()["problem"] == "unwatched"


@pytest.mark.parametrize("seed", range(3))
def test_scaling_as_a_column(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(30), rng.randrange(400), rng.randrange(20)) for i in range(40)]
    t = spark.createDataFrame(rows, "i int, tasks int, work long, idle long")
    got = {r["i"]: r["n"] for r in t.select("i", metrics.scaled(F.col("tasks"), 2, 2, 20, F.col("work"), F.col("idle")).alias("n")).collect()}
    assert got == {i: metrics.scale(c, 2, 2, 20, w, d) for i, c, w, d in rows}
