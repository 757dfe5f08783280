"""The registered change-stream queries, each with the DuckDB query it must equal."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import scalars
from .functions.types import ColumnType, coerce
from .operators import decode, envelope, lineage, metrics, ownership, rebalance, schema, syncfold, watermark
from .plans.fixtures import BASE_US, NOW_US, fixture, oracle
from .streaming import lifecycle, sink

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

STREAM = {"project_id": "p", "instance_id": "i", "database_id": "d", "change_stream_name": "s1"}
USERS = {"user_id": ColumnType("INT64"), "value": ColumnType("FLOAT64")}


def query(sql: str | None = None):
    """Register a query; sql: its oracle, over the tables and the fixtures."""

    def take(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = oracle(sql)
        return f

    return take


def data_record() -> Column:
    """The wire's struct of a row of changes, integers as strings."""
    user, text = F.col("user_id").cast("string"), lambda v: F.when(v.isNotNull(), F.create_map(F.lit("value"), v.cast("string")))
    mod = F.struct(F.create_map(F.lit("user_id"), user).alias("keys"), text(F.col("old_value")).alias("old_values"), text(F.col("value")).alias("new_values"))
    return F.struct(F.struct(
        F.concat(F.date_format(F.timestamp_micros("commit_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lpad(F.col("commit_nanos").cast("string"), 3, "0"), F.lit("Z")).alias("commit_timestamp"),
        "record_sequence", F.col("txn_id").alias("server_transaction_id"), F.col("is_last").alias("is_last_record_in_transaction_in_partition"), "table_name",
        F.array(mod).alias("mods"), "mod_type", F.col("capture_type").alias("value_capture_type"), F.col("n_records").alias("number_of_records_in_transaction"),
    ).alias("data_change_record"))


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes as the wire has them: partition_token, commit_us and a record as JSON text."""
    return fixture(spark, sf_dir, "changes").select("partition_token", "commit_us", F.to_json(data_record()).alias("record"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_json(wire(spark, sf_dir))


def mods(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return envelope.explode_mods(records(spark, sf_dir), **options)


# ---------------------------------------------------------------- envelopes


_UID = " || ".join(f"chr(97 + CAST(n // {26**p} % 26 AS INTEGER))" for p in range(7, -1, -1))


@query(f"""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY partition_token ORDER BY commit_us, commit_nanos, record_sequence, txn_id) - 1 AS n FROM changes WHERE table_name <> 'audit'),
r AS (SELECT *, unnest(CASE WHEN mod_type = 'DELETE' THEN [false, true] ELSE [false] END) AS tombstone FROM t)
SELECT 'cdc.' || table_name AS topic, user_id, CASE WHEN NOT tombstone THEN CASE mod_type WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END END AS op,
  CASE WHEN NOT tombstone AND mod_type <> 'INSERT' THEN old_value END AS before_value, CASE WHEN NOT tombstone AND mod_type <> 'DELETE' THEN value END AS after_value,
  commit_ms, tombstone, {_UID} AS record_uid
FROM r""")
def cdc_envelope(spark, sf_dir):
    m = envelope.with_record_uid(mods(spark, sf_dir, exclude="AUDIT"))
    e = envelope.with_tombstones(envelope.envelope(m, USERS, ["user_id"], STREAM))
    return e.select("topic", F.col("key.user_id").alias("user_id"), "op", F.col("before.value").alias("before_value"), F.col("after.value").alias("after_value"),
                    F.col("ts_ms").alias("commit_ms"), "tombstone", "record_uid")


@query("SELECT 'cdc.' || table_name AS topic, mod_type, count(*) AS n, count(DISTINCT user_id) AS keys FROM changes GROUP BY ALL")
def topic_counts(spark, sf_dir):
    m = mods(spark, sf_dir)
    return m.groupBy(F.concat(F.lit("cdc."), F.col("data.table_name")).alias("topic"), F.col("data.mod_type").alias("mod_type")).agg(
        F.count("*").alias("n"), F.count_distinct(F.col("mod.keys")["user_id"]).alias("keys"))


@query("SELECT user_id, commit_ms FROM changes WHERE mod_type = 'DELETE'")
def cdc_tombstones(spark, sf_dir):
    e = envelope.with_tombstones(envelope.envelope(mods(spark, sf_dir), USERS, ["user_id"], STREAM))
    return e.where("tombstone").select(F.col("key.user_id").alias("user_id"), F.col("ts_ms").alias("commit_ms"))


@query("""SELECT txn_id, CAST(record_sequence AS BIGINT) AS record_sequence, commit_ms, capture_type, partition_token, table_name, CAST(0 AS BIGINT) AS mod_number, is_last, n_records
FROM changes WHERE lower(table_name) = 'users'""")
def cdc_source_info(spark, sf_dir):
    m = mods(spark, sf_dir, include="user.*")
    s = m.select(envelope.source_info(STREAM).alias("s"))
    return s.select(F.col("s.server_transaction_id").alias("txn_id"), "s.record_sequence", F.col("s.ts_ms").alias("commit_ms"), F.col("s.value_capture_type").alias("capture_type"),
                    "s.partition_token", F.col("s.table").alias("table_name"), F.col("s.mod_number").cast("long").alias("mod_number"),
                    F.col("s.is_last_record_in_transaction_in_partition").alias("is_last"), F.col("s.number_records_in_transaction").alias("n_records"))


@query("""SELECT * FROM (VALUES (0, CAST(42 AS BIGINT), true, CAST(2.5 AS DOUBLE), CAST(1.5 AS FLOAT), 'x', 'bytesVal', CAST('1.10' AS VARCHAR), 2), (1, CAST(0 AS BIGINT), false, 0.0, CAST(0 AS FLOAT), '', NULL, 'abc', 2),
  (2, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL), (3, CAST(9007199254740993 AS BIGINT), false, -1.0, CAST(0 AS FLOAT), 'é', '', '1', 0))
  AS t(id, i, b, f, f32, s, bytes_text, n, elements)""")
def cdc_type_coercion(spark, sf_dir):
    rows = [(0, "42", "true", "2.5", "1.5", "x", "Ynl0ZXNWYWw=", "1.10", '["1.1","2"]'), (1, "abc", "yes", "zz", "", "", "!", "abc", '["a",null]'),
            (2, None, None, None, None, None, None, None, None), (3, "9007199254740993", "FALSE", "-1", "x", "é", "", "1", "[]")]
    t = spark.createDataFrame(rows, "id int, i string, b string, f string, f32 string, s string, y string, n string, a string")
    c = lambda name, kind: coerce(F.col(name), ColumnType(kind)).alias(name)
    arrays = coerce(F.col("a"), ColumnType("ARRAY", ColumnType("FLOAT64")))
    return t.select("id", c("i", "INT64"), c("b", "BOOL"), c("f", "FLOAT64"), c("f32", "FLOAT32"), c("s", "STRING"), F.nullif(F.decode(F.try_to_binary("y", F.lit("base64")), "UTF-8"), F.lit("-")).alias("bytes_text"),
                    c("n", "NUMERIC"), F.when(F.col("a").isNotNull(), F.size(arrays)).alias("elements"))


@query("SELECT commit_us AS ts_us, 'insert' AS kind, user_id, value FROM changes WHERE mod_type = 'INSERT' AND is_last")
def cdc_inserts_last(spark, sf_dir):
    m = mods(spark, sf_dir).where("data.mod_type = 'INSERT' AND data.is_last_record_in_transaction_in_partition")
    e = envelope.envelope(m, USERS, ["user_id"], STREAM)
    return e.select("ts_us", F.lit("insert").alias("kind"), "key.user_id", "after.value")


@query("SELECT user_id, min(commit_us) AS first_us, arg_min(value, commit_us) FILTER (value IS NOT NULL) AS first_value FROM changes WHERE mod_type <> 'DELETE' GROUP BY user_id")
def cdc_first_per_key(spark, sf_dir):
    e = envelope.envelope(mods(spark, sf_dir), USERS, ["user_id"], STREAM).where("op <> 'd'")
    return e.groupBy("key.user_id").agg(F.min("ts_us").alias("first_us"), F.min_by("after.value", F.when(F.col("after.value").isNotNull(), F.col("ts_us"))).alias("first_value"))


@query("SELECT partition_token, txn_id, record_sequence, user_id FROM changes WHERE table_name = 'users'")
def cdc_deduplicated(spark, sf_dir):
    once = mods(spark, sf_dir, include="users")
    m = envelope.deduplicated(once.union(once.where("mod_number = 0")))
    return m.select("partition_token", F.col("data.server_transaction_id").alias("txn_id"), F.col("data.record_sequence").alias("record_sequence"), F.col("mod.keys")["user_id"].cast("long").alias("user_id"))


@query("""SELECT event_id, 'operation: ' || CASE mod_type WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END || ', key: {"user_id":' || user_id || '}' AS line FROM changes""")
def cdc_summary(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes")
    none = F.lit(None).cast("struct<a:int>")
    return c.select("event_id", envelope.summary(envelope.operation(F.col("mod_type")), none, F.struct("user_id"), none, none).alias("line"))


# ---------------------------------------------------------------- decoding and routing

def _kinds(spark):
    beat = {"heartbeat_record": {"timestamp": "2024-01-01T00:00:11Z"}}
    child = lambda *parents: {"child_partitions_record": {"start_timestamp": "2024-01-01T00:00:12Z", "record_sequence": "1", "child_partitions": [
        {"token": "c1", "parent_partition_tokens": list(parents)}, {"token": "c2", "parent_partition_tokens": [*parents, "q"]}]}}
    data = {"data_change_record": {"commit_timestamp": "2024-01-01T00:00:10.000000020Z", "record_sequence": "1", "server_transaction_id": "t", "table_name": "a",
            "mods": [{"keys": {"id": "1"}, "new_values": {"v": "2"}}, {"keys": {"id": "2"}}], "mod_type": "NEW_MOD_TYPE", "value_capture_type": "NEW_ROW"}}
    rows = [("p1", json.dumps(data)), ("p1", json.dumps(beat)), ("p1", json.dumps(child("p1"))), ("Parent0", json.dumps(child()))]
    return decode.decode_json(spark.createDataFrame(rows, "partition_token string, record string"))


@query("SELECT * FROM (VALUES ('child', 2, CAST(2 AS BIGINT)), ('data', 0, 1), ('heartbeat', 1, 1)) AS t(record_type, record_rank, n)")
def decode_json_kinds(spark, sf_dir):
    return _kinds(spark).groupBy("record_type", "record_rank").agg(F.count("*").alias("n"))


@query("SELECT 'UNKNOWN' AS mod_type, 'NEW_ROW' AS capture_type, 2 AS mods, CAST(1704067210 AS BIGINT) AS sec, 20 AS nanos")
def decode_unknown_enums(spark, sf_dir):
    d = _kinds(spark).where("record_type = 'data'").withColumn("k", scalars.order_key(F.col("data.commit_timestamp")))
    return d.select("data.mod_type", F.col("data.value_capture_type").alias("capture_type"), F.size("data.mods").alias("mods"), "k.sec", "k.nanos")


@query("""SELECT * FROM (VALUES ('p1', 'c1', 'p1', '2024-01-01T00:00:12Z', 'end of p1'), ('p1', 'c2', 'p1,q', '2024-01-01T00:00:12Z', 'end of p1'),
('Parent0', 'c1', 'Parent0', '2024-01-01T00:00:12Z', NULL), ('Parent0', 'c2', 'Parent0,q', '2024-01-01T00:00:12Z', NULL)) AS t(origin, token, parents, start_time, end_time)""")
def decode_child_partitions(spark, sf_dir):
    read = _kinds(spark).withColumn("until", F.when(F.col("partition_token") == "p1", F.lit("end of p1")))
    return decode.children(read, "until").select("origin", "token", F.array_join("parents", ",").alias("parents"), F.col("start").alias("start_time"), F.col("end").alias("end_time"))


@query("SELECT capture_type, count(*) AS n, count(old_value) AS old, CAST(sum(CASE WHEN value IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS new FROM changes GROUP BY ALL")
def decode_mods_capture_types(spark, sf_dir):
    m = mods(spark, sf_dir)
    return m.groupBy(F.col("data.value_capture_type").alias("capture_type")).agg(
        F.count("*").alias("n"), F.count(F.col("mod.old_values")["value"]).alias("old"), F.sum(F.when(F.col("mod.new_values")["value"].isNull(), 0).otherwise(1)).cast("long").alias("new"))


@query("SELECT event_id, user_id, value, CASE WHEN old_value IS NULL THEN 0 ELSE 1 END AS olds FROM changes")
def decode_positional_values(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes")
    v = lambda i, x: F.struct(F.lit(i).alias("column_index"), x.cast("string").alias("value"))
    none = F.array().cast("array<struct<column_index:int,value:string>>")
    old = F.when(F.col("old_value").isNotNull(), F.array(v(1, F.col("old_value")))).otherwise(none)
    mod = F.struct(F.array(v(0, F.col("user_id"))).alias("keys"), old.alias("old_values"), F.array(v(1, F.col("value"))).alias("new_values"))
    meta = F.array(F.struct(F.lit("user_id").alias("name")), F.struct(F.lit("value").alias("name")))
    d = decode.decode_positional(c.select("event_id", F.array(mod).alias("mods"), meta.alias("column_metadata"))).withColumn("m", F.get("mods", F.lit(0)))
    return d.select("event_id", F.col("m.keys")["user_id"].cast("long").alias("user_id"), F.col("m.new_values")["value"].cast("double").alias("value"), F.size("m.old_values").alias("olds"))


@query("""SELECT 'data' AS record_type, 0 AS record_rank, event_id, partition_token, commit_us FROM changes WHERE event_id % 11 <> 0
UNION ALL SELECT 'heartbeat', 1, event_id, partition_token, commit_us FROM changes WHERE event_id % 5 = 0
UNION ALL SELECT 'child', 2, event_id, partition_token, commit_us FROM changes WHERE event_id % 7 = 0""")
def decode_nested_rows(spark, sf_dir):
    """Rows of three arrays: data records (of every eleventh event a null one), heartbeats of every fifth, children of every seventh."""
    c = fixture(spark, sf_dir, "changes")
    data = F.from_json(F.to_json(data_record()), decode.WIRE)["data_change_record"]
    at, none = F.date_format(F.timestamp_micros("commit_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), lambda t: F.array().cast(f"array<{t}>")
    beat = F.struct(at.alias("timestamp"))
    child = F.struct(at.alias("start_timestamp"), F.lit("1").alias("record_sequence"), F.array(F.struct(F.lit("c").alias("token"), F.array("partition_token").alias("parent_partition_tokens"))).alias("child_partitions"))
    every = lambda n: F.col("event_id") % n == 0
    rows = c.select("event_id", "partition_token", F.array(F.struct(
        F.array(F.when(~every(11), data)).alias("data_change_record"),
        F.when(every(5), F.array(beat)).otherwise(none(decode.HEARTBEAT)).alias("heartbeat_record"),
        F.when(every(7), F.array(child)).otherwise(none(decode.CHILD)).alias("child_partitions_record"))).alias("change_record"))
    d = decode.decode(rows, "google")
    stamp = F.coalesce("data.commit_timestamp", "heartbeat.timestamp", "child.start_timestamp")
    return d.select("record_type", "record_rank", "event_id", "partition_token", scalars.epoch_micros(stamp).alias("commit_us"))


@query("SELECT table_name, count(*) AS n FROM changes WHERE table_name IN ('users', 'orders_cdc') GROUP BY ALL")
def table_include(spark, sf_dir):
    return mods(spark, sf_dir, include=".*s, ORDERS_.*", exclude="users").groupBy(F.col("data.table_name").alias("table_name")).agg(F.count("*").alias("n"))


@query("SELECT table_name, count(*) AS n FROM changes WHERE table_name = 'audit' GROUP BY ALL")
def table_exclude(spark, sf_dir):
    return mods(spark, sf_dir, exclude="users,orders.*").groupBy(F.col("data.table_name").alias("table_name")).agg(F.count("*").alias("n"))


@query("SELECT 'data' AS record_type, partition_token, count(*) AS n, max(commit_us) AS last_us FROM changes GROUP BY ALL")
def route_record_types(spark, sf_dir):
    return records(spark, sf_dir).groupBy("record_type", "partition_token").agg(F.count("*").alias("n"), F.max(scalars.epoch_micros(F.col("data.commit_timestamp"))).alias("last_us"))


# ---------------------------------------------------------------- schemas


@query("""SELECT stream, all_tables, table_name, all_columns, coalesce(string_agg(DISTINCT column_name, ',' ORDER BY column_name), '') AS columns FROM streams GROUP BY ALL""")
def stream_def_left_join(spark, sf_dir):
    s = fixture(spark, sf_dir, "streams")
    tables = s.where("table_name IS NOT NULL").select("stream", "table_name", "all_columns").distinct()
    columns = s.where("column_name IS NOT NULL").select("stream", "table_name", "column_name")
    return schema.stream_definition(s.select("stream", "all_tables").distinct(), tables, columns).withColumn("columns", F.array_join("columns", ","))


@query("""SELECT s.table_name, s.column_name, ordinal, valid_from, k.column_name IS NOT NULL AS is_primary_key FROM schemas s
LEFT JOIN key_columns k ON k.table_name = s.table_name AND k.column_name = s.column_name AND index_name = 'PRIMARY_KEY'""")
def pk_lookup(spark, sf_dir):
    s, k = fixture(spark, sf_dir, "schemas"), schema.key_scan(fixture(spark, sf_dir, "key_columns"))
    return schema.with_keys(s, k).select("table_name", "column_name", "ordinal", "valid_from", "is_primary_key")


@query("""WITH n AS (SELECT * FROM schemas WHERE valid_from > 0), p AS (SELECT * FROM schemas WHERE valid_from = 0 AND table_name IN (SELECT table_name FROM n))
SELECT coalesce(n.table_name, p.table_name) AS table_name, coalesce(n.column_name, p.column_name) AS column_name, coalesce(n.type_text, p.type_text) AS type_text, n.table_name IS NULL AS retained
FROM p FULL JOIN n ON n.table_name = p.table_name AND n.column_name = p.column_name""")
def schema_merge(spark, sf_dir):
    s = fixture(spark, sf_dir, "schemas")
    return schema.merge(s.where("valid_from = 0").drop("valid_from"), s.where("valid_from > 0").drop("valid_from")).select("table_name", "column_name", "type_text", "retained")


@query("""SELECT s.table_name, s.column_name, s.type_text FROM schemas s JOIN (SELECT table_name, max(valid_from) AS v FROM schemas WHERE valid_from <= 1705999999999999 GROUP BY ALL) m
ON m.table_name = s.table_name AND m.v = s.valid_from""")
def schema_asof(spark, sf_dir):
    return schema.as_of(fixture(spark, sf_dir, "schemas"), 1705999999999999).select("table_name", "column_name", "type_text")


@query("""SELECT event_id, (SELECT max(valid_from) FROM schemas s WHERE s.table_name = c.table_name AND s.valid_from <= c.commit_us) AS schema_version FROM changes c""")
def schema_asof_events(spark, sf_dir):
    return schema.as_of_events(fixture(spark, sf_dir, "changes"), fixture(spark, sf_dir, "schemas"), "commit_us").select("event_id", F.col("schema_version").cast("long").alias("schema_version"))


@query("""WITH s AS (SELECT * FROM schemas WHERE valid_from = 0), r AS (SELECT * FROM schemas WHERE valid_from > 0),
w AS (SELECT s.table_name, s.column_name FROM s WHERE s.table_name = 'orders_cdc' OR s.table_name = 'users' AND s.column_name IN ('user_id', 'name', 'value'))
SELECT r.table_name, r.column_name, CASE WHEN s.type_text IS NULL THEN 'missing' WHEN w.column_name IS NULL THEN 'unwatched' ELSE 'type' END AS problem
FROM r LEFT JOIN s ON s.table_name = r.table_name AND s.column_name = r.column_name LEFT JOIN w ON w.table_name = r.table_name AND w.column_name = r.column_name
WHERE s.type_text IS NULL OR w.column_name IS NULL OR s.type_text <> r.type_text""")
def schema_validate(spark, sf_dir):
    s = schema.with_keys(fixture(spark, sf_dir, "schemas"), schema.key_scan(fixture(spark, sf_dir, "key_columns")))
    return schema.validate(s.where("valid_from > 0"), s.where("valid_from = 0"), watched_projection(spark, sf_dir))


@query("""SELECT s.table_name, s.column_name FROM schemas s WHERE valid_from = 0 AND (s.table_name = 'orders_cdc' OR s.table_name = 'users' AND s.column_name IN ('user_id', 'name', 'value'))""")
def watched_projection(spark, sf_dir):
    s = schema.with_keys(fixture(spark, sf_dir, "schemas").where("valid_from = 0"), schema.key_scan(fixture(spark, sf_dir, "key_columns")))
    st = fixture(spark, sf_dir, "streams")
    tables = st.where("table_name IS NOT NULL").select("stream", "table_name", "all_columns").distinct()
    d = schema.stream_definition(st.select("stream", "all_tables").distinct(), tables, st.where("column_name IS NOT NULL").select("stream", "table_name", "column_name"))
    return schema.projected(s, d, "s1").select("table_name", "column_name")


# ---------------------------------------------------------------- watermarks

_LIVE = """WITH owned AS (SELECT * FROM {c} WHERE kind = 'owned'),
live AS (SELECT * FROM owned WHERE state_ord NOT IN (4, 5) UNION ALL SELECT * FROM {c} WHERE kind = 'shared' AND token NOT IN (SELECT token FROM owned)),
twice AS (SELECT count(*) AS duplicates FROM (SELECT token FROM live GROUP BY token HAVING count(*) > 1))
SELECT CASE WHEN duplicates = 0 THEN min(coalesce(offset_us, start_us)) END AS low_watermark_us, count(DISTINCT live.token) AS partitions, duplicates
FROM live LEFT JOIN offsets ON offsets.token = live.token CROSS JOIN twice GROUP BY duplicates"""


@query(_LIVE.format(c="partitions"))
def low_watermark(spark, sf_dir):
    return watermark.low_watermark(fixture(spark, sf_dir, "partitions"), fixture(spark, sf_dir, "offsets"))


@query(_LIVE.format(c="claims"))
def low_watermark_duplicates_null(spark, sf_dir):
    return watermark.low_watermark(fixture(spark, sf_dir, "claims"), fixture(spark, sf_dir, "offsets"))


@query(f"""WITH owned AS (SELECT * FROM partitions WHERE kind = 'owned'), live AS (SELECT token FROM owned WHERE state_ord NOT IN (4, 5) UNION ALL
SELECT token FROM partitions WHERE kind = 'shared' AND token NOT IN (SELECT token FROM owned)) SELECT {BASE_US + 77} AS low_watermark_us, count(*) + 1 AS partitions, CAST(0 AS BIGINT) AS duplicates FROM live""")
def low_watermark_root_override(spark, sf_dir):
    p = fixture(spark, sf_dir, "partitions")
    root = spark.createDataFrame([("task0", "owned", "Parent0", 3, BASE_US + 77, None, None)], p.schema)
    return watermark.low_watermark(p.unionByName(root), fixture(spark, sf_dir, "offsets"))


_STAMP = """'cdc.' || table_name AS topic, p AS output_partition, 'm' AS op, 'p' AS project, 'i' AS instance, 'd' AS database, 's1' AS stream, table_name AS source_table,
  CAST(NULL AS VARCHAR) AS txn_id, CAST(NULL AS BIGINT) AS ts_ms, CAST(NULL AS INTEGER) AS mod_number, CAST(NULL AS VARCHAR) AS source_token"""


def _stamped(stamps: DataFrame) -> DataFrame:
    s = lambda n, to: F.col(f"source.{n}").alias(to)
    return stamps.select("topic", "output_partition", "op", s("project_id", "project"), s("instance_id", "instance"), s("database_id", "database"), s("change_stream_name", "stream"), s("table", "source_table"),
                         s("server_transaction_id", "txn_id"), s("ts_ms", "ts_ms"), s("mod_number", "mod_number"), s("partition_token", "source_token"), s("low_watermark", "source_low_watermark"))


@query(f"SELECT {_STAMP}, CAST({BASE_US // 1000} AS BIGINT) AS source_low_watermark FROM (SELECT DISTINCT table_name FROM changes) t, (SELECT range AS p FROM range(0, 4)) r")
def watermark_stamps_cross(spark, sf_dir):
    tables = fixture(spark, sf_dir, "changes").select("table_name").distinct()
    return _stamped(watermark.stamps(tables, 4, F.lit(BASE_US // 1000).cast("long"), STREAM))


@query(f"""SELECT at_ms, {_STAMP}, at_ms - 5000 AS source_low_watermark FROM (SELECT DISTINCT table_name FROM changes) t, (SELECT range AS p FROM range(0, 2)) r,
(SELECT {BASE_US // 1000} + range * 10000 AS at_ms FROM range(1, 7)) m""")
def watermark_stamps_on_a_cadence(spark, sf_dir):
    """What a publisher sends in a minute, one stamp for each period of ten seconds, table and output partition."""
    tables = fixture(spark, sf_dir, "changes").select("table_name").distinct()
    out = None
    for at in watermark.stamp_times(BASE_US, BASE_US + 60_000_000):
        one = _stamped(watermark.stamps(tables, 2, F.lit(at // 1000 - 5000).cast("long"), STREAM)).withColumn("at_ms", F.lit(at // 1000).cast("long"))
        out = one if out is None else out.union(one)
    return out


@query("""SELECT partition_token, commit_us - event_id % 5 * 1000000 AS low_watermark_us, event_id,
  max(commit_us - event_id % 5 * 1000000) OVER (PARTITION BY partition_token ORDER BY event_id) AS monotone FROM changes""")
def low_watermark_monotone(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").select("partition_token", "event_id", (F.col("commit_us") - F.col("event_id") % 5 * 1000000).alias("low_watermark_us"))
    return watermark.monotone(c, "partition_token", "event_id")


# ---------------------------------------------------------------- lineage


@query("SELECT token, count(*) AS parents, min(parent) AS priority FROM edges GROUP BY token")
def merge_child_priority(spark, sf_dir):
    return lineage.priority_parent(fixture(spark, sf_dir, "edges"))


@query("""WITH p AS (SELECT token, min(parent) AS priority, count(*) AS n FROM edges GROUP BY token) SELECT e.token, e.parent AS origin FROM edges e JOIN p ON p.token = e.token WHERE n < 2 OR parent = priority""")
def accepted_children(spark, sf_dir):
    e = fixture(spark, sf_dir, "edges")
    return lineage.accepted_children(e.select("token", F.col("parent").alias("origin")), e)


@query("SELECT token, parent FROM edges")
def edges_explode(spark, sf_dir):
    e = fixture(spark, sf_dir, "edges").groupBy("token").agg(F.sort_array(F.collect_set("parent")).alias("parents"))
    return lineage.edges_of(e)


@query("""WITH known AS (SELECT token AS parent, max(state_ord) AS s FROM claims GROUP BY token),
p AS (SELECT e.token, count(*) AS n, count(s) AS known, sum(CASE WHEN s >= 4 THEN 1 ELSE 0 END) AS done FROM edges e LEFT JOIN known ON known.parent = e.parent GROUP BY e.token)
SELECT c.task_uid, c.token, c.kind FROM claims c LEFT JOIN p ON p.token = c.token WHERE state_ord = 0 AND (n IS NULL OR known = 0 OR done = n)""")
def eligible_partitions(spark, sf_dir):
    return lineage.eligible(fixture(spark, sf_dir, "claims"), fixture(spark, sf_dir, "edges")).select("task_uid", "token", "kind")


@query(f"""SELECT token, task_uid FROM partitions WHERE state_ord = 4 AND finished_us + 7200000000 <= {NOW_US}
AND token NOT IN (SELECT parent FROM edges e JOIN partitions c ON c.token = e.token WHERE c.state_ord NOT IN (4, 5))""")
def removable_partitions(spark, sf_dir):
    return lineage.removable(fixture(spark, sf_dir, "partitions"), fixture(spark, sf_dir, "edges"), NOW_US).select("token", "task_uid")


@query("""WITH RECURSIVE d AS (SELECT DISTINCT parent AS token, CAST(0 AS BIGINT) AS depth FROM edges WHERE parent NOT IN (SELECT token FROM edges)
UNION SELECT e.token, depth + 1 FROM edges e JOIN d ON d.token = e.parent) SELECT token, max(depth) AS depth FROM d GROUP BY token""")
def lineage_depth(spark, sf_dir):
    return lineage.depths(fixture(spark, sf_dir, "edges"))


@query("""SELECT token, parent AS origin, (row_number() OVER (PARTITION BY parent ORDER BY token) - 1) // 200 AS batch FROM (SELECT token, 'Parent0' AS parent FROM edges UNION ALL SELECT token, parent FROM edges)""")
def initial_token_batches(spark, sf_dir):
    e = fixture(spark, sf_dir, "edges")
    t = e.select("token", F.lit("Parent0").alias("origin")).union(e.select("token", F.col("parent").alias("origin")))
    return lineage.initial_batches(t)


@query("""SELECT false AS ended, count(DISTINCT CASE WHEN state_ord NOT IN (4, 5) THEN token END) AS in_progress, count(DISTINCT CASE WHEN state_ord = 4 THEN token END) AS finished FROM claims
UNION ALL SELECT true, 0, count(DISTINCT token) FROM claims WHERE state_ord = 4""")
def end_detection(spark, sf_dir):
    c = fixture(spark, sf_dir, "claims")
    return lineage.stream_ended(c, NOW_US, BASE_US).union(lineage.stream_ended(c.where("state_ord = 4"), NOW_US, BASE_US))


@query("SELECT c.task_uid, c.token FROM claims c WHERE state_ord = 1 AND NOT EXISTS (SELECT 1 FROM claims o WHERE o.token = c.token AND o.task_uid <> c.task_uid AND o.state_ord >= 2)")
def already_streaming_anti(spark, sf_dir):
    c = fixture(spark, sf_dir, "claims")
    return lineage.already_streaming(c.where("state_ord = 1"), c).select("task_uid", "token")


@query("SELECT e.token, e.parent FROM edges e WHERE e.token NOT IN (SELECT token FROM partitions WHERE state_ord < 3)")
def new_partitions(spark, sf_dir):
    return lineage.new_tokens(fixture(spark, sf_dir, "edges"), fixture(spark, sf_dir, "partitions").where("state_ord < 3"))


# ---------------------------------------------------------------- ownership

_LOAD = """WITH l AS (SELECT task_uid, token FROM claims WHERE kind = 'owned' AND state_ord NOT IN (4, 5) UNION SELECT assignee, token FROM claims WHERE kind = 'shared' AND assignee IS NOT NULL),
loads AS (SELECT t.task_uid, count(token) AS load FROM (SELECT DISTINCT task_uid FROM claims) t LEFT JOIN l ON l.task_uid = t.task_uid GROUP BY t.task_uid)"""


@query(f"{_LOAD} SELECT task_uid, load FROM loads")
def task_load(spark, sf_dir):
    return ownership.load(fixture(spark, sf_dir, "claims"))


@query(f"{_LOAD} SELECT task_uid, load FROM loads ORDER BY load, task_uid <> 'task3', task_uid LIMIT 1")
def least_loaded_task(spark, sf_dir):
    return ownership.least_loaded(ownership.load(fixture(spark, sf_dir, "claims")), "task3")


@query("SELECT token, task_uid, kind, state_ord FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY state_ord, task_uid) AS n FROM claims) WHERE n = 1")
def dedup_partition_state(spark, sf_dir):
    return ownership.first_by_state(fixture(spark, sf_dir, "claims")).select("token", "task_uid", "kind", "state_ord")


@query("SELECT token, task_uid, assignee FROM claims WHERE kind = 'shared' AND token NOT IN (SELECT token FROM claims WHERE kind = 'owned')")
def shared_not_owned(spark, sf_dir):
    return ownership.shared_not_owned(fixture(spark, sf_dir, "claims")).select("token", "task_uid", "assignee")


@query("""SELECT count(DISTINCT CASE WHEN kind = 'owned' AND state_ord NOT IN (4, 5) THEN token END) AS owned,
count(DISTINCT CASE WHEN kind = 'shared' AND token NOT IN (SELECT token FROM claims WHERE kind = 'owned') THEN token END) AS shared_only FROM claims""")
def partition_counts(spark, sf_dir):
    return ownership.partition_counts(fixture(spark, sf_dir, "claims"))


@query("SELECT token, count(*) AS claims FROM claims WHERE state_ord NOT IN (4, 5) GROUP BY token HAVING count(*) > 1")
def duplicated_tokens(spark, sf_dir):
    return ownership.duplicated(fixture(spark, sf_dir, "claims"))


@query("SELECT count(DISTINCT CASE WHEN state_ord NOT IN (4, 5) THEN token END) AS in_progress, count(DISTINCT CASE WHEN state_ord = 4 THEN token END) AS finished, count(DISTINCT token) AS all_tokens FROM claims")
def token_totals(spark, sf_dir):
    return ownership.token_totals(fixture(spark, sf_dir, "claims"))


@query("SELECT token, task_uid FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY state_ord, task_uid) AS n FROM claims WHERE kind = 'shared' AND assignee = 'task2') WHERE n = 1")
def shared_to_take(spark, sf_dir):
    return ownership.to_take(fixture(spark, sf_dir, "claims"), "task2").select("token", "task_uid")


@query("SELECT token, task_uid, kind FROM claims WHERE kind = 'owned' OR token NOT IN (SELECT token FROM claims WHERE kind = 'owned')")
def shared_cleared(spark, sf_dir):
    return ownership.still_shared(fixture(spark, sf_dir, "claims")).select("token", "task_uid", "kind")


@query(f"""{_LOAD} SELECT task_uid, load, allowed FROM loads, (SELECT count(DISTINCT CASE WHEN state_ord NOT IN (4, 5) THEN token END) // count(DISTINCT task_uid) * 2 AS allowed FROM claims) a WHERE load > 2 AND load > allowed""")
def overloaded_tasks(spark, sf_dir):
    return ownership.overloaded(fixture(spark, sf_dir, "claims"), 2)


@query("SELECT task_uid, kind, count(*) AS claims, task_uid IN ('task0', 'task1', 'task2') AS survived FROM claims GROUP BY ALL")
def survived_obsolete(spark, sf_dir):
    c = fixture(spark, sf_dir, "claims")
    alive = spark.createDataFrame([(f"task{i}",) for i in range(3)], "task_uid string")
    a, b = ownership.survivors(c, alive)
    both = a.withColumn("survived", F.lit(True)).union(b.withColumn("survived", F.lit(False)))
    return both.groupBy("task_uid", "kind", "survived").agg(F.count("*").alias("claims"))


# ---------------------------------------------------------------- the sync log


@query("SELECT task_uid, log_offset, state_ts, generation FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, log_offset) AS n FROM sync_log) WHERE n = 1")
def latest_task_state(spark, sf_dir):
    return syncfold.latest_states(fixture(spark, sf_dir, "sync_log")).select("task_uid", "log_offset", "state_ts", "generation")


@query("""SELECT log_offset, message_type, generation FROM sync_log WHERE NOT (message_type IN ('NEW_EPOCH', 'UPDATE_EPOCH') AND generation < 3 OR message_type = 'REBALANCE_ANSWER' AND (generation < 3 OR generation < 4))""")
def stale_generation_filter(spark, sf_dir):
    return syncfold.fresh(fixture(spark, sf_dir, "sync_log"), 3, 4).select("log_offset", "message_type", "generation")


@query("""SELECT 'consumer' || range AS consumer_id FROM range(0, 80) WHERE 'consumer' || range NOT IN (SELECT consumer_id FROM sync_log WHERE message_type = 'REBALANCE_ANSWER' AND generation = 0)""")
def missing_consumers(spark, sf_dir):
    expected = spark.range(80).select(F.concat(F.lit("consumer"), F.col("id").cast("string")).alias("consumer_id"))
    return syncfold.missing_consumers(expected, fixture(spark, sf_dir, "sync_log"), 0)


@query("SELECT DISTINCT consumer_id, task_uid FROM sync_log WHERE message_type = 'REBALANCE_ANSWER' AND generation = 0")
def matched_consumers(spark, sf_dir):
    expected = spark.range(80).select(F.concat(F.lit("consumer"), F.col("id").cast("string")).alias("consumer_id"))
    return syncfold.matched(expected, fixture(spark, sf_dir, "sync_log"), 0)


@query("""WITH base AS (SELECT * FROM sync_log WHERE log_offset < 50), start AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, log_offset) AS n FROM base) WHERE n = 1),
m AS (SELECT * FROM sync_log WHERE log_offset >= 50), known AS (SELECT task_uid FROM start UNION SELECT task_uid FROM m WHERE message_type <> 'REGULAR'),
every AS (SELECT *, 1 AS old FROM start UNION ALL SELECT *, 0 FROM m WHERE message_type <> 'REGULAR' OR task_uid IN (SELECT task_uid FROM known))
SELECT task_uid, log_offset, state_ts FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, old DESC, log_offset) AS n FROM every) WHERE n = 1""")
def merged_states(spark, sf_dir):
    log = fixture(spark, sf_dir, "sync_log")
    start = syncfold.latest_states(log.where("log_offset < 50"))
    return syncfold.merged(start, log.where("log_offset >= 50")).select("task_uid", "log_offset", "state_ts")


@query("""WITH l AS (SELECT * FROM sync_log WHERE log_offset >= 500), s AS (SELECT task_uid, log_offset FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, log_offset) AS n FROM l) WHERE n = 1)
SELECT 'NEW_EPOCH' AS kind, task_uid, log_offset FROM s UNION ALL SELECT 'REGULAR', task_uid, log_offset FROM s WHERE task_uid = 'task5'""")
def sync_messages(spark, sf_dir):
    s = syncfold.latest_states(syncfold.from_offset(fixture(spark, sf_dir, "sync_log"), 500))
    n = lambda k: syncfold.message(s, k, "task5").select(F.lit(k).alias("kind"), "task_uid", "log_offset")
    return n("NEW_EPOCH").union(n("REGULAR"))


@query("""SELECT task_uid, log_offset, message_type FROM sync_log WHERE message_type <> 'REGULAR' UNION ALL
SELECT task_uid, max(log_offset), 'REGULAR' FROM sync_log WHERE message_type = 'REGULAR' GROUP BY task_uid, log_offset // 100""")
def coalesced_publishing(spark, sf_dir):
    return syncfold.coalesced(fixture(spark, sf_dir, "sync_log"), 100, "log_offset").select("task_uid", "log_offset", "message_type")


_GREEDY = """WITH alive AS (SELECT unnest(['task0', 'task1', 'task2']) AS task_uid), gone AS (SELECT * FROM claims WHERE task_uid NOT IN (SELECT task_uid FROM alive)),
own AS (SELECT token, kind, state_ord, assignee, 0 AS step FROM claims WHERE task_uid = 'task0'),
g1 AS (SELECT token, kind, state_ord, assignee, 1 AS step FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY state_ord, task_uid) AS n FROM gone WHERE kind = 'owned' AND state_ord = 4) WHERE n = 1 AND token NOT IN (SELECT token FROM own)),
h1 AS (SELECT * FROM own UNION ALL SELECT * FROM g1),
g2 AS (SELECT token, kind, state_ord, assignee, 2 AS step FROM (SELECT token, kind, assignee, CASE WHEN state_ord IN (2, 3) THEN 1 ELSE state_ord END AS state_ord,
  row_number() OVER (PARTITION BY token ORDER BY CASE WHEN state_ord IN (2, 3) THEN 1 ELSE state_ord END, task_uid) AS n FROM gone WHERE kind = 'owned' AND state_ord <> 4) WHERE n = 1 AND token NOT IN (SELECT token FROM h1)),
h2 AS (SELECT * FROM h1 UNION ALL SELECT * FROM g2),
g3 AS (SELECT token, CASE WHEN a THEN 'shared' ELSE 'owned' END AS kind, state_ord, CASE WHEN a THEN assignee END AS assignee, 3 AS step FROM (SELECT *, assignee IN ('task1', 'task2') AS a,
  row_number() OVER (PARTITION BY token ORDER BY state_ord, task_uid) AS n FROM gone WHERE kind = 'shared') WHERE n = 1 AND token NOT IN (SELECT token FROM h2)),
h3 AS (SELECT * FROM h2 UNION ALL SELECT * FROM g3),
g4 AS (SELECT token, 'owned' AS kind, state_ord, NULL AS assignee, 4 AS step FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY state_ord, task_uid) AS n FROM claims
  WHERE task_uid IN ('task1', 'task2') AND kind = 'shared' AND assignee NOT IN ('task1', 'task2')) WHERE n = 1 AND token NOT IN (SELECT token FROM h3))
SELECT token, kind, state_ord, assignee, step FROM h3 UNION ALL SELECT * FROM g4"""


@query(_GREEDY)
def rebalance_greedy(spark, sf_dir):
    alive = spark.createDataFrame([(f"task{i}",) for i in range(3)], "task_uid string")
    return rebalance.greedy(fixture(spark, sf_dir, "claims"), "task0", alive)


_EQUAL = """WITH alive AS (SELECT unnest(['task0', 'task1', 'task2']) AS t), stay AS (SELECT * FROM claims WHERE task_uid IN (SELECT t FROM alive)), gone AS (SELECT * FROM claims WHERE task_uid NOT IN (SELECT t FROM alive)),
owned AS (SELECT token FROM stay WHERE kind = 'owned'), spoken AS (SELECT * FROM stay WHERE kind = 'shared' AND assignee IN (SELECT t FROM alive)),
one AS (SELECT DISTINCT 'owned' AS kind, token, CAST(4 AS BIGINT) AS state_ord, CAST(NULL AS VARCHAR) AS assignee FROM gone WHERE kind = 'owned' AND state_ord = 4 AND token NOT IN (SELECT token FROM owned)),
two AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY state_ord, task_uid) AS n FROM gone WHERE kind = 'shared' AND assignee IN (SELECT t FROM alive)) WHERE n = 1
  AND token NOT IN (SELECT token FROM owned UNION SELECT token FROM one UNION SELECT token FROM spoken)),
lost AS (SELECT token, min(c) AS c FROM (SELECT token, 0 AS c FROM gone WHERE kind = 'shared' UNION ALL SELECT token, 1 FROM stay WHERE kind = 'shared' AND assignee NOT IN (SELECT t FROM alive)
  UNION ALL SELECT token, 2 FROM gone WHERE kind = 'owned' AND state_ord NOT IN (4, 5)) WHERE token NOT IN (SELECT token FROM owned UNION SELECT token FROM one UNION SELECT token FROM spoken UNION SELECT token FROM two) GROUP BY token),
held AS (SELECT task_uid AS t, token FROM stay WHERE kind = 'owned' AND state_ord NOT IN (4, 5) UNION SELECT assignee, token FROM spoken UNION SELECT assignee, token FROM two),
loads AS (SELECT alive.t, count(token) AS load FROM alive LEFT JOIN held ON held.t = alive.t GROUP BY alive.t),
places AS (SELECT t, row_number() OVER (ORDER BY load + k, t <> 'task0', t) AS n FROM loads, (SELECT range AS k FROM range(0, 200000)) WHERE k < (SELECT count(*) FROM lost)),
given AS (SELECT token, t FROM (SELECT token, row_number() OVER (ORDER BY c, token) AS n FROM lost) l JOIN places ON places.n = l.n),
fresh AS (SELECT * FROM one UNION ALL SELECT CASE WHEN assignee = 'task0' THEN 'owned' ELSE 'shared' END, token, state_ord, nullif(assignee, 'task0') FROM two
  UNION ALL SELECT CASE WHEN t = 'task0' THEN 'owned' ELSE 'shared' END, token, 0, nullif(t, 'task0') FROM given),
mine AS (SELECT kind, token, state_ord, assignee FROM stay WHERE task_uid = 'task0' AND (kind = 'owned' OR assignee IN (SELECT t FROM alive)) UNION ALL SELECT * FROM fresh)"""


@query(f"""{_EQUAL} SELECT 'task0' AS task_uid, kind, token, state_ord, assignee FROM mine WHERE kind = 'owned' OR token NOT IN (SELECT token FROM mine WHERE kind = 'owned')""")
def rebalance_equal_sharing(spark, sf_dir):
    return rebalance.share_equally(fixture(spark, sf_dir, "claims"), "task0", ["task0", "task1", "task2"])


# ---------------------------------------------------------------- offsets and record ids


@query("SELECT p.token, CASE WHEN offset_us IS NULL OR offset_us < start_us THEN start_us ELSE offset_us END AS resume_us FROM partitions p LEFT JOIN offsets o ON o.token = p.token")
def resume_position(spark, sf_dir):
    p = fixture(spark, sf_dir, "partitions").join(fixture(spark, sf_dir, "offsets"), "token", "left")
    return p.select("token", scalars.resume_position(F.col("offset_us"), F.col("start_us")).alias("resume_us"))


@query(f"""SELECT partition_token, event_id, {_UID} AS record_uid FROM
(SELECT partition_token, event_id, row_number() OVER (PARTITION BY partition_token ORDER BY commit_us, commit_nanos, record_sequence, txn_id) - 1 AS n FROM changes)""")
def record_uid_sequence(spark, sf_dir):
    m = envelope.with_record_uid(mods(spark, sf_dir))
    place = F.col("data.record_sequence").cast("long") + 4 * F.substr("data.server_transaction_id", F.lit(3)).cast("long")
    return m.select("partition_token", place.alias("event_id"), "record_uid")


@query("""WITH r AS (SELECT partition_token AS token, max(event_id) AS last_record, max(CASE WHEN publish_ms IS NOT NULL THEN event_id END) AS last_ack FROM changes GROUP BY ALL)
SELECT token, last_ack = last_record AS finished FROM r UNION ALL SELECT 'silent', true""")
def finish_ready(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").select(F.col("partition_token").alias("token"), F.lpad(F.col("event_id").cast("string"), 19, "0").alias("uid"), "publish_ms")
    finishing = c.select("token").distinct().union(spark.createDataFrame([("silent",)], "token string"))
    return lifecycle.finish_ready(c.select("token", "uid"), c.where("publish_ms IS NOT NULL").select("token", "uid"), finishing)


# ---------------------------------------------------------------- measurements


@query(f"""SELECT event_id, poll_ms - commit_ms AS total_latency, poll_ms - read_ms AS read_to_emit_latency, read_ms - commit_ms AS database_latency, poll_ms - commit_ms AS commit_to_emit_latency,
publish_ms - commit_ms AS commit_to_publish_latency, publish_ms - poll_ms AS emit_to_publish_latency, emit_ms - read_ms AS own_latency,
{NOW_US // 1000} - commit_ms AS low_watermark_lag, {NOW_US // 1000} - commit_ms AS behind_low_watermark FROM changes""")
def latency_family(spark, sf_dir):
    return metrics.latency_table(fixture(spark, sf_dir, "changes"), F.col("commit_ms"), F.lit(NOW_US // 1000))


@query("""SELECT partition_token, min(publish_ms - commit_ms) AS min_value, max(publish_ms - commit_ms) AS max_value, CAST(sum(publish_ms - commit_ms) AS DOUBLE) / count(publish_ms) AS avg_value,
arg_max(publish_ms - commit_ms, event_id) FILTER (publish_ms IS NOT NULL) AS last_value, count(publish_ms) AS values FROM changes GROUP BY ALL""")
def latency_statistics(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").withColumn("lag", F.col("publish_ms") - F.col("commit_ms"))
    return metrics.statistics(c, "lag", "event_id", "partition_token")


@query("""SELECT table_name, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM changes GROUP BY ALL""")
def latency_quantiles_exact(spark, sf_dir):
    q = metrics.quantiles(fixture(spark, sf_dir, "changes"), "value", "table_name")
    return q.select("table_name", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])  # the last bits differ by engine


@query("""WITH n AS (SELECT table_name, commit_us // 864000000000 AS interval, value FROM changes WHERE value IS NOT NULL)
SELECT table_name, interval, count(*) AS values, true AS close FROM n GROUP BY ALL""")
def latency_quantiles_approx(spark, sf_dir):
    """Sketched p50, p95 and p99 of each interval of ten days, each within one hundredth of the value of its rank."""
    c = fixture(spark, sf_dir, "changes").select("table_name", "commit_us", "value")
    q = metrics.quantiles_by_interval(c, "value", "commit_us", 864_000_000_000, "table_name")
    inner = c.where("value IS NOT NULL").groupBy("table_name", F.floor(F.col("commit_us") / 864_000_000_000).cast("long").alias("interval"))
    exact = inner.agg(F.count("*").alias("values"), F.sort_array(F.collect_list("value")).alias("v"))
    rank = lambda p: F.get("v", F.floor(F.lit(p) * (F.col("values") - 1)).cast("int"))
    near = lambda p, name: F.abs(F.col(name) - rank(p)) <= 0.01000001 * F.abs(rank(p))
    both = q.join(exact, ["table_name", "interval"])
    return both.select("table_name", "interval", "values", (near(0.5, "p50") & near(0.95, "p95") & near(0.99, "p99")).alias("close"))


@query(f"SELECT event_id, {NOW_US // 1000} - commit_ms AS lag FROM changes WHERE {NOW_US // 1000} - commit_ms > 500000000")
def slow_records(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").select("event_id", (F.lit(NOW_US // 1000) - F.col("commit_ms")).alias("lag"))
    return metrics.slow(c, "lag", limit=500_000_000)


#: The last event of a partition, within 5000 seconds however many there are.
_LAST = f"({BASE_US} + (start_us - {BASE_US}) % 5000000000)"


@query(f"""SELECT token, ({BASE_US} + 5000000000 - {_LAST}) // 300000000 AS intervals, {_LAST} < {BASE_US} + 5000000000 - 3000000000 AS is_stuck FROM partitions""")
def stuck_partitions(spark, sf_dir):
    p = fixture(spark, sf_dir, "partitions").withColumn("last_us", F.expr(_LAST))
    return metrics.stuck(p, "last_us", F.lit(BASE_US + 5_000_000_000), 300_000_000).select("token", "intervals", "is_stuck")


@query("""SELECT count(DISTINCT CASE WHEN state_ord NOT IN (4, 5) THEN token END) AS in_work, count(DISTINCT task_uid) AS tasks,
count(DISTINCT task_uid) - count(DISTINCT CASE WHEN kind = 'owned' AND state_ord NOT IN (4, 5) THEN task_uid END) AS idle FROM claims""")
def task_activity(spark, sf_dir):
    return metrics.task_activity(fixture(spark, sf_dir, "claims"))


@query("""WITH RECURSIVE s AS (SELECT * FROM (VALUES (1, 2, 2, 20, 2, 10, 0), (2, 5, 2, 20, 2, 10, 0), (3, 5, 1, 100, 2, 300, 0), (4, 10, 2, 20, 2, 4, 8), (5, 3, 2, 10, 2, 1, 3)) AS t(id, tasks, desired, most, least, work, idle)
UNION ALL SELECT id, least(most, tasks + CAST(ceil(tasks * 0.2) AS INTEGER)), desired, most, least, work, idle FROM s WHERE work / tasks > desired AND tasks < most),
f AS (SELECT id, max(tasks) AS tasks FROM s GROUP BY id), v AS (SELECT DISTINCT id, desired, least, work, idle FROM s)
SELECT f.id, CAST(CASE WHEN tasks > least AND work / tasks < desired AND idle > tasks * 0.5 THEN greatest(tasks // 2, least) ELSE tasks END AS INTEGER) AS tasks FROM f JOIN v ON v.id = f.id""")
def scale_decision(spark, sf_dir):
    rows = [(1, 0, 2, 20, 2, 10, 0), (2, 5, 2, 20, 2, 10, 0), (3, 5, 1, 100, 2, 300, 0), (4, 10, 2, 20, 2, 4, 8), (5, 3, 2, 10, 2, 1, 3)]
    return spark.createDataFrame([(i, metrics.scale(c, d, least, most, w, idle)) for i, c, d, most, least, w, idle in rows], "id int, tasks int")


@query("""SELECT event_type AS name, sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'click') AS total, count(*) FILTER (event_type <> 'click') AS times, arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS last,
string_agg(DISTINCT 'table' || user_id % 5, ',' ORDER BY 'table' || user_id % 5) AS names FROM events GROUP BY event_type""")
def metric_counters(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.when(F.col("event_type") == "click", "sum").otherwise("count")
    table = F.concat(F.lit("table"), (F.col("user_id") % 5).cast("string"))
    c = metrics.counters(e.select(F.col("event_type").alias("name"), kind.alias("kind"), F.round(F.col("value") * 100).cast("long").alias("value"), table.alias("text"), F.col("event_id").alias("at")))
    return c.select("name", "total", "times", "last", F.array_join("names", ",").alias("names"))


# ---------------------------------------------------------------- bulk: one record for each order


LINES = {"l_orderkey": ColumnType("INT64"), "l_partkey": ColumnType("INT64"), "l_quantity": ColumnType("FLOAT64")}


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with many mods: an order's lineitems, deletes of returned ones and inserts of the others; partition_token, record."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    text = lambda n, c: (F.lit(n), c.cast("string"))
    lines = F.sort_array(F.collect_list(F.struct("l_partkey", "l_quantity", "l_returnflag")))
    one = line.groupBy("l_orderkey", (F.col("l_returnflag") == "R").alias("gone")).agg(lines.alias("lines"))
    none = F.lit(None).cast("map<string,string>")

    def mod(x):
        quantity = F.create_map(*text("l_quantity", x["l_quantity"]))
        keys = F.create_map(*text("l_orderkey", F.col("l_orderkey")), *text("l_partkey", x["l_partkey"]))
        return F.struct(keys.alias("keys"), F.when(F.col("gone"), quantity).otherwise(none).alias("old_values"), F.when(~F.col("gone"), quantity).otherwise(none).alias("new_values"))

    one = one.select("l_orderkey", "gone", F.transform("lines", mod).alias("mods"))
    record = F.struct(F.struct(
        F.lit("2024-01-01T00:00:00Z").alias("commit_timestamp"), F.when(F.col("gone"), "1").otherwise("0").alias("record_sequence"), F.col("l_orderkey").cast("string").alias("server_transaction_id"),
        F.lit("lineitem").alias("table_name"), "mods", F.when(F.col("gone"), "DELETE").otherwise("INSERT").alias("mod_type"), F.lit("OLD_AND_NEW_VALUES").alias("value_capture_type"),
    ).alias("data_change_record"))
    return one.select(F.concat(F.lit("p"), (F.col("l_orderkey") % 8).cast("string")).alias("partition_token"), F.to_json(record).alias("record"))


@query("""SELECT 'cdc.lineitem' AS topic, l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY l_partkey, l_quantity, l_returnflag) - 1 AS mod_number,
CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'c' END AS op, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS before_quantity, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS after_quantity FROM lineitem""")
def order_change_mods(spark, sf_dir):
    m = envelope.explode_mods(decode.decode_json(_order_records(spark, sf_dir)))
    number = F.col("mod_number").cast("long")
    e = envelope.envelope(m.withColumn("number", number), LINES, ["l_orderkey", "l_partkey"], STREAM)
    return e.select("topic", "key.l_orderkey", "key.l_partkey", F.col("number").alias("mod_number"), "op", F.col("before.l_quantity").alias("before_quantity"), F.col("after.l_quantity").alias("after_quantity"))


@query("""SELECT txn_id, max(n_records) AS declared, count(*) AS received, max(n_records) = count(*) AS complete FROM changes WHERE table_name <> 'audit' GROUP BY txn_id""")
def txn_completeness(spark, sf_dir):
    m = mods(spark, sf_dir, exclude="audit").where("mod_number = 0")  # the records that a filtered reader receives
    t = m.groupBy(F.col("data.server_transaction_id").alias("txn_id")).agg(F.max("data.number_of_records_in_transaction").alias("declared"), F.count("*").alias("received"))
    return t.withColumn("complete", F.col("declared") == F.col("received"))


@query("""SELECT CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'c' END AS op, count(*) AS mods, count(DISTINCT l_orderkey) AS records, CAST(max(n) - 1 AS INTEGER) AS last_mod FROM
(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R') AS n FROM lineitem) GROUP BY 1""")
def order_record_sizes(spark, sf_dir):
    m = envelope.explode_mods(decode.decode_json(_order_records(spark, sf_dir)))
    g = m.groupBy(envelope.operation(F.col("data.mod_type")).alias("op"))
    return g.agg(F.count("*").alias("mods"), F.count_distinct("data.server_transaction_id").alias("records"), F.max("mod_number").cast("int").alias("last_mod"))


@query("""SELECT user_id, min(commit_us) AS started, count(*) AS events FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY commit_us) AS burst FROM
(SELECT *, CASE WHEN commit_us - lag(commit_us) OVER (PARTITION BY user_id ORDER BY commit_us) < 600000000 THEN 0 ELSE 1 END AS fresh FROM changes)) GROUP BY user_id, burst""")
def rebalance_debounce(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").select("user_id", F.timestamp_micros("commit_us").alias("ts"))
    b = syncfold.rebalance_bursts(c, "10 minutes", "ts", "user_id")
    return b.select("user_id", F.unix_micros("started").alias("started"), "events")


@query("""WITH cutoff AS (SELECT max(log_offset) AS m FROM sync_log), base AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, log_offset) AS n FROM sync_log, cutoff WHERE log_offset * 3 < m * 2) WHERE n = 1),
m AS (SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, log_offset) AS n FROM sync_log, cutoff WHERE log_offset * 2 > m) WHERE n = 1),
b AS (SELECT *, 1 AS old FROM base WHERE task_uid IN (SELECT task_uid FROM m) UNION ALL SELECT *, 0 FROM m WHERE task_uid <> 'task5')
SELECT task_uid, log_offset, state_ts FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, old DESC) AS n FROM b) WHERE n = 1""")
def epoch_update(spark, sf_dir):
    """The first two thirds of the log against its second half."""
    log = fixture(spark, sf_dir, "sync_log")
    log = log.crossJoin(log.agg(F.max("log_offset").alias("most")))  # one row
    states, message = syncfold.latest_states(log.where("log_offset * 3 < most * 2")), syncfold.latest_states(log.where("log_offset * 2 > most"))
    return syncfold.epoch_update(states, message, "task5").select("task_uid", "log_offset", "state_ts")


@query("""WITH c AS (SELECT token, bool_or(NOT (task_uid IN ('task3', 'task4') AND kind = 'owned' AND state_ord = 5)) AS lives FROM claims GROUP BY token),
l AS (SELECT token FROM c WHERE lives) SELECT token, true AS known FROM l""")
def new_epoch(spark, sf_dir):
    """Every token but those that only gone tasks had removed is in the new epoch."""
    c = fixture(spark, sf_dir, "claims")
    answered = spark.createDataFrame([("c1", "task1"), ("c2", "task2")], "consumer_id string, task_uid string")
    out = rebalance.new_epoch(c, "task0", answered, answered.select("consumer_id"))
    return out.select("token").distinct().withColumn("known", F.lit(True))


@query("""SELECT * FROM (VALUES ('end', 'a', '2024-01-01T00:00:02Z', false, '', ''), ('event', 'a', '2024-01-01T00:00:01Z', false, 'b', 'c,d'), ('start', 'x', '2024-01-01T00:00:00Z', true, '', ''),
('start', 'y', '2024-01-01T00:00:00Z', true, '', '')) AS t(kind, token, time, from_root, moved_from, moved_to)""")
def partition_records(spark, sf_dir):
    kinds = ("partition_token string, partition_start struct<start_timestamp:string,partition_tokens:array<string>>, "
             "partition_event struct<commit_timestamp:string,partition_token:string,move_in:array<string>,move_out:array<string>>, partition_end struct<end_timestamp:string,partition_token:string>")  # fmt: skip
    rows = [("Parent0", ("2024-01-01T00:00:00Z", ["x", "y"]), None, None), ("a", None, ("2024-01-01T00:00:01Z", "a", ["b"], ["c", "d"]), None), ("a", None, None, ("2024-01-01T00:00:02Z", "a"))]
    d = decode.partition_records(spark.createDataFrame(rows, kinds))
    return d.select("kind", "token", "time", "from_root", F.array_join("moved_from", ",").alias("moved_from"), F.array_join("moved_to", ",").alias("moved_to"))


@query(f"SELECT partition_token, max(commit_ms) AS at_ms FROM changes GROUP BY partition_token HAVING {NOW_US // 1000} - max(commit_ms) > 60000")
def late_heartbeats(spark, sf_dir):
    h = fixture(spark, sf_dir, "changes").groupBy("partition_token").agg(F.max("commit_ms").alias("at_ms"))
    return metrics.late_heartbeats(h, F.lit(NOW_US // 1000))


@query(f"SELECT max(({BASE_US} + 5000000000 - {_LAST}) // 300000000) AS longest FROM partitions WHERE token <> 'Parent0'")
def longest_stuck(spark, sf_dir):
    p = metrics.stuck(fixture(spark, sf_dir, "partitions").withColumn("last_us", F.expr(_LAST)), "last_us", F.lit(BASE_US + 5_000_000_000), 300_000_000)
    return p.agg(F.max("intervals").alias("longest"))


@query("SELECT user_id, count(*) AS n, true AS one_partition, true AS in_order FROM changes GROUP BY user_id")
def key_order(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").select(F.col("user_id").alias("key"), F.col("commit_us").alias("ts_us"))
    p = sink.by_key(c, 8).select("key", "ts_us", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("row"))
    p = p.withColumn("later", F.col("ts_us") >= F.coalesce(F.lag("ts_us").over(Window.partitionBy("key").orderBy("row")), F.col("ts_us")))
    return p.groupBy(F.col("key").alias("user_id")).agg(F.count("*").alias("n"), (F.count_distinct("p") == 1).alias("one_partition"), F.bool_and("later").alias("in_order"))


from . import task_queries  # noqa: E402, F401  (registers the rest)
