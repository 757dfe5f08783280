"""Registered queries over a reader's settings, catalog, sources, task operations and their log, with the DuckDB queries they must equal."""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from .functions import scalars
from .functions.types import ColumnType, parse_ddl, parse_type_json, spark_type
from .operators import decode, envelope, metrics, operations, ownership, rebalance, schema, syncfold
from .plans.config import ConfigError, ReaderConfig
from .plans.fixtures import BASE_US, NOW_US, fixture
from .plans.work import cut, workdir
from .queries import _LAST, STREAM, USERS, mods, query, records, wire
from .sources import change_stream
from .streaming import lifecycle, sink

# ---------------------------------------------------------------- settings

_GOOD = {"database": "d", "stream": "s", "project": "p", "instance": "i"}
_OMNI = {**_GOOD, "kind": "omni", "host": "h"}
#: Settings and what is wrong with them: survey row, changed settings, problems.
_SETTINGS = [
    ("V1", {"heartbeat_ms": "99"}, ["heartbeat_ms must lie between 100 and 300000"]),
    ("V1 low", {"heartbeat_ms": "100"}, []),
    ("V1 high", {"heartbeat_ms": "300001"}, ["heartbeat_ms must lie between 100 and 300000"]),
    ("V2", {"database": " ", "stream": ""}, ["database must not be blank", "stream must not be blank"]),
    ("V3", {"credentials_path": "/nowhere/at/all"}, ["credentials_path must be an existing file"]),
    ("V3 folder", {"credentials_path": "/"}, ["credentials_path must be an existing file"]),
    ("V4", {"credentials_json": "{"}, ["credentials_json must be JSON"]),
    ("V4 blank", {"credentials_json": " "}, ["credentials_json must be JSON"]),
    ("V4 right", {"credentials_json": '{"a": 1}'}, []),
    ("V5", {"capture_mode": "NEW_ROW"}, ["capture_mode must be one of OLD_AND_NEW_VALUES"]),
    ("V5 right", {"capture_mode": "OLD_AND_NEW_VALUES"}, []),
    ("V6", {"start": "yesterday"}, ["start must be an instant such as 2024-01-31T00:00:00Z"]),
    ("V6 nanos", {"start": "2024-01-01T00:00:00.123456789Z"}, []),
    ("V7", {"start": "2024-01-02T00:00:00Z", "end": "2024-01-01T00:00:00Z"}, ["end must not lie before start"]),
    ("V7 equal", {"start": "2024-01-01T00:00:00Z", "end": "2024-01-01T00:00:00Z"}, []),
    ("V8", {"project": "", "instance": ""}, ["project is needed for a cloud database", "instance is needed for a cloud database"]),
    ("V9", {"ca_cert": "c"}, ["ca_cert is for omni databases"]),
    ("V9 plain", {**_OMNI, "plaintext": "true", "ca_cert": "c"}, ["plaintext excludes certificates"]),
    ("V9 pair", {**_OMNI, "client_cert": "c"}, ["client_cert and client_key go together"]),
    ("V9 host", {"kind": "omni"}, ["host is needed for an omni database"]),
    ("V10", {"host": "a", "emulator_host": "b"}, ["host and emulator_host exclude each other"]),
    ("V11", {"heartbeat_ms": "1", "stream": "", "capture_mode": "ALL"},
     ["capture_mode must be one of OLD_AND_NEW_VALUES", "heartbeat_ms must lie between 100 and 300000", "stream must not be blank"]),
    ("V11 unknown", {"nonsense": "1", "max_tasks": "x"}, ["max_tasks must be a whole number", "unknown setting: nonsense"]),
    ("V11 right", {}, []),
]


def _values(rows: list[tuple], names: str) -> str:
    """A VALUES list as a DuckDB query."""
    one = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) AS t({names})"


@query(_values([(n, "; ".join(sorted(p))) for n, _, p in _SETTINGS], "case_name, problems"))
def reader_settings(spark, sf_dir):
    def problems(changed: dict) -> str:
        try:
            ReaderConfig.of({**_GOOD, **changed})
        except ConfigError as e:
            return "; ".join(sorted(e.problems))
        return ""

    return spark.createDataFrame([(n, problems(c)) for n, c, _ in _SETTINGS], "case_name string, problems string")


# ---------------------------------------------------------------- refused inputs

_REFUSED = ["read operation", "unknown record kind", "null record", "missing field", "mutable ranges in postgres", "unknown dialect", "record column of another type", "source without a name",
            "key that is none", "struct column", "array of arrays", "consumer without an answer"]


@query(_values([(n, True) for n in _REFUSED], "input, refused"))
def refused_inputs(spark, sf_dir):
    """What must raise does: each small input is run on its own."""
    one = lambda text: spark.createDataFrame([("p", text)], "partition_token string, record string")
    key = lambda k: spark.createDataFrame([("t", "id", "INT64", k)], "table_name string, column_name string, type_text string, is_primary_key boolean")
    answered = spark.createDataFrame([("c1", "task1")], "consumer_id string, task_uid string")
    expected = spark.createDataFrame([("c1",), ("c2",)], "consumer_id string")
    claims = fixture(spark, sf_dir, "claims").limit(1)
    tries = [
        lambda: spark.range(1).select(envelope.operation(F.lit("READ"))).collect(),
        lambda: decode.decode_json(one('{"other":1}')).collect(),
        lambda: decode.decode_json(one(None)).collect(),
        lambda: decode.decode_json(one('{"data_change_record":{"table_name":"t"}}')).collect(),
        lambda: decode.wire_dialect("postgres", True),
        lambda: decode.wire_dialect("oracle"),
        lambda: decode.decode_json(one("1").withColumn("record", F.lit(1))),
        lambda: envelope.source_info({"project_id": "p"}),
        lambda: schema.validate(key(True), key(False)).collect(),
        lambda: spark_type(ColumnType("STRUCT")),
        lambda: spark_type(ColumnType("ARRAY", ColumnType("ARRAY", ColumnType("BOOL")))),
        lambda: rebalance.new_epoch(claims, "task0", answered, expected),
    ]

    def refused(run) -> bool:
        try:
            run()
        except (ValueError, PySparkException):
            return True
        return False

    return spark.createDataFrame([(n, refused(run)) for n, run in zip(_REFUSED, tries, strict=True)], "input string, refused boolean")


# ---------------------------------------------------------------- records and envelopes


@query("SELECT partition_token, commit_ms AS ts_ms, 0 AS output_partition FROM changes WHERE event_id % 3 = 0")
def heartbeat_topic(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes").where("event_id % 3 = 0")
    at = F.date_format(F.timestamp_micros("commit_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    beat = F.struct(F.struct(at.alias("timestamp")).alias("heartbeat_record"))
    h = envelope.heartbeats(decode.decode(c.select("partition_token", F.to_json(beat).alias("record")), "postgres"))
    return h.select("key.partition_token", "value.ts_ms", "output_partition")


@query("""SELECT event_id, strftime(make_timestamp(commit_us), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(commit_us % 1000000 AS VARCHAR), 6, '0') || lpad(CAST(commit_nanos AS VARCHAR), 3, '0') || 'Z' AS position,
CAST(NULL AS VARCHAR) AS started FROM changes""")
def envelope_offsets(spark, sf_dir):
    e = envelope.envelope(mods(spark, sf_dir).withColumn("event_id", _event_id()), USERS, ["user_id"], STREAM)
    return e.select("event_id", F.col("offset")["offset"].alias("position"), F.col("offset")["startTime"].alias("started"))


def _event_id():
    """The event that a record of wire() was made from."""
    return F.col("data.record_sequence").cast("long") + 4 * F.substr("data.server_transaction_id", F.lit(3)).cast("long")


@query("""SELECT event_id, 3 + CASE WHEN publish_ms IS NULL THEN 0 ELSE 1 END AS headers, CAST(emit_ms AS VARCHAR) AS emitted, CAST(publish_ms AS VARCHAR) AS published, event_id % 2 = 0 AS data_change FROM changes""")
def record_headers(spark, sf_dir):
    c = fixture(spark, sf_dir, "changes")
    uid = F.when(F.col("event_id") % 2 == 0, scalars.record_uid(F.col("event_id")))
    h = c.select("event_id", envelope.headers(uid, F.col("emit_ms"), F.col("poll_ms"), F.col("publish_ms")).alias("h"))
    count = F.size("h") + F.when(envelope.is_data_change(F.col("h")), 0).otherwise(1)
    return h.select("event_id", count.alias("headers"), F.col("h")["emitTimestamp"].alias("emitted"), F.col("h")["publishTimestamp"].alias("published"), envelope.is_data_change(F.col("h")).alias("data_change"))


@query("""SELECT event_id, commit_ms AS at_ms, txn_id, CAST(CAST(record_sequence AS BIGINT) AS VARCHAR) AS sequence, table_name FROM changes WHERE event_id % 10 <> 0 UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL FROM changes WHERE event_id % 10 = 0""")
def event_positions(spark, sf_dir):
    """Timestamp, transaction and position of each record; none where there is no value, here of every tenth."""
    m = mods(spark, sf_dir).select(_event_id().alias("event_id"), envelope.source_info(STREAM).alias("s"))
    value = F.when(F.col("event_id") % 10 != 0, F.lit(1))
    m = m.select("event_id", envelope.event_metadata(F.col("s"), value).alias("m"))
    return m.select("event_id", F.col("m.timestamp").alias("at_ms"), F.col("m.transaction_id").alias("txn_id"), F.col("m.position")["record_sequence"].alias("sequence"), F.col("m.position")["table"].alias("table_name"))


@query("SELECT event_id, 'p' || user_id % 8 AS partition_token, commit_ms, CAST(7 AS BIGINT) AS started_ms, commit_ms + 5 AS read_ms FROM changes")
def read_metadata(spark, sf_dir):
    r = records(spark, sf_dir)
    commit = scalars.epoch_millis(F.col("data.commit_timestamp"))
    r = decode.with_read_metadata(r, commit + 5, F.lit(7).cast("long"))
    return r.select(_event_id().alias("event_id"), "_meta.partition_token", scalars.epoch_millis(F.col("_meta.record_timestamp")).alias("commit_ms"),
                    F.col("_meta.query_started_at").alias("started_ms"), F.col("_meta.record_read_at").alias("read_ms"))


@query("SELECT 'string' AS form, event_id, mod_type FROM changes UNION ALL SELECT 'variant', event_id, mod_type FROM changes")
def decode_text_and_variant(spark, sf_dir):
    """Record columns of both types that hold JSON, by the dialect that writes it."""
    w = wire(spark, sf_dir)
    one = lambda t, form: decode.decode(t, "postgres").select(F.lit(form).alias("form"), _event_id().alias("event_id"), "data.mod_type")
    return one(w, "string").union(one(w.withColumn("record", F.parse_json("record")), "variant"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'data' END AS record_type FROM changes")
def decode_null_text(spark, sf_dir):
    """Null text is an empty object: a record of no kind, where that is allowed."""
    c = fixture(spark, sf_dir, "changes").select("event_id", "partition_token")
    text = F.when(F.col("event_id") % 4 != 0, F.lit('{"data_change_record":{"table_name":"t"}}'))
    return decode.decode_json(c.withColumn("record", text), strict=False).select("event_id", "record_type")


# ---------------------------------------------------------------- the catalog

_FIELD = """CASE WHEN type_text LIKE 'STRING%' OR type_text IN ('NUMERIC', 'DATE') THEN 'string' WHEN type_text = 'INT64' THEN 'bigint' ELSE 'double' END"""


@query(f"""WITH c AS (SELECT s.*, k.column_name IS NOT NULL AS is_key, s.column_name || ' ' || {_FIELD} AS field FROM schemas s LEFT JOIN key_columns k ON k.table_name = s.table_name AND k.column_name = s.column_name AND index_name = 'PRIMARY_KEY')
SELECT table_name, valid_from, string_agg(field, ',' ORDER BY ordinal) FILTER (is_key) AS key_fields, string_agg(field, ',' ORDER BY ordinal) AS value_fields FROM c GROUP BY ALL""")
def typed_schemas(spark, sf_dir):
    """Key and value types of each version of each table, columns by their place, read through the cache."""
    s = schema.with_keys(fixture(spark, sf_dir, "schemas"), schema.key_scan(fixture(spark, sf_dir, "key_columns")))
    held: dict = {}
    for r in s.collect():  # the catalog: as many rows as columns
        held.setdefault((r["table_name"], r["valid_from"]), []).append(r.asDict())
    cache = schema.SchemaCache(lambda t, v: schema.struct_types(held[t, v]))
    text = lambda t: None if t is None else ",".join(f"{f.name} {f.dataType.simpleString()}" for f in t.fields)
    rows = [(t, v, *map(text, cache.of(t, v))) for t, v in held]
    return spark.createDataFrame(rows, "table_name string, valid_from long, key_fields string, value_fields string")


@query("""WITH v AS (SELECT c.event_id, c.table_name, (SELECT max(valid_from) FROM schemas s WHERE s.table_name = c.table_name AND s.valid_from <= c.commit_us) AS version FROM changes c)
SELECT table_name, version, count(*) AS reads, CAST(1 AS BIGINT) AS loads FROM v GROUP BY ALL""")
def schema_cache_loads(spark, sf_dir):
    """A reader that meets the tables' versions in time loads each once; a change of version clears what it holds."""
    e = schema.as_of_events(fixture(spark, sf_dir, "changes"), fixture(spark, sf_dir, "schemas"), "commit_us")
    seen = e.groupBy("table_name", "schema_version").agg(F.count("*").alias("reads"), F.min("commit_us").alias("first")).sort("first", "table_name").collect()
    loads: dict = {}

    def load(table, version):
        loads[table, version] = loads.get((table, version), 0) + 1
        return version

    cache, last, rows = schema.SchemaCache(load), {}, []
    for r in seen:  # as many rows as versions
        if last.get(r["table_name"]) not in (None, r["schema_version"]):
            cache.reset()
        last[r["table_name"]] = r["schema_version"]
        cache.of(r["table_name"], r["schema_version"])
        cache.of(r["table_name"], r["schema_version"])
        rows.append((r["table_name"], r["schema_version"], r["reads"], loads[r["table_name"], r["schema_version"]]))
    return spark.createDataFrame(rows, "table_name string, version long, reads long, loads long")


@query("""SELECT 'google' AS dialect, table_name, column_name FROM schemas WHERE valid_from = 0 AND table_name IN ('users', 'audit') AND column_name <> 'name'
UNION ALL SELECT 'postgres', table_name, column_name FROM schemas WHERE valid_from = 0 AND column_name = 'name'""")
def catalog_columns(spark, sf_dir):
    c = fixture(spark, sf_dir, "schemas").where("valid_from = 0").withColumn("table_schema", F.when(F.col("column_name") == "name", "public").otherwise(""))
    google = schema.columns_scan(c, ["users", "audit"]).select(F.lit("google").alias("dialect"), "table_name", "column_name")
    return google.union(schema.columns_scan(c, None, "postgres").select(F.lit("postgres"), "table_name", "column_name"))


@query(_values([("s1", "google", True, True), ("s2", "google", True, False), ("S1", "google", False, False), ("S1", "postgres", True, False), ("s9", "google", False, False)], "stream, dialect, found, mutable"))
def stream_catalog(spark, sf_dir):
    s = fixture(spark, sf_dir, "streams")
    options = s.select("stream").distinct().select("stream", F.lit("partition_mode").alias("option_name"), F.when(F.col("stream") == "s1", "MUTABLE_KEY_RANGE").otherwise("IMMUTABLE_KEY_RANGE").alias("option_value"))
    asked = [("s1", "google"), ("s2", "google"), ("S1", "google"), ("S1", "postgres"), ("s9", "google")]
    return spark.createDataFrame([(n, d, schema.stream_exists(s, n, d), schema.mutable_ranges(options, n)) for n, d in asked], "stream string, dialect string, found boolean, mutable boolean")


_DDL = [("int64", "google", "INT64"), ("STRING(MAX)", "google", "STRING"), ("Bytes(10)", "google", "BYTES"), ("ARRAY<FLOAT32>", "google", "ARRAY of FLOAT32"), ("ARRAY<STRING(5)>", "google", "ARRAY of STRING"),
        ("JSON", "google", "JSON"), ("TOKENLIST", "google", "TOKENLIST"), ("UUID", "google", "UUID"), ("timestamp", "google", "TIMESTAMP"), ("INTEGER", "google", "unknown"), ("STRUCT<a INT64>", "google", "unknown"),
        ("bigint", "postgres", "INT64"), ("character varying(9)", "postgres", "STRING"), ("double  precision", "postgres", "FLOAT64"), ("real", "postgres", "FLOAT32"), ("bytea", "postgres", "BYTES"),
        ("timestamp with time zone", "postgres", "TIMESTAMP"), ("spanner.commit_timestamp", "postgres", "TIMESTAMP"), ("jsonb", "postgres", "JSON"), ("boolean[]", "postgres", "ARRAY of BOOL"),
        ("numeric(3,1)", "postgres", "NUMERIC"), ("int64", "postgres", "unknown"), ('{"code":"INT64"}', "record", "INT64"), ('{"code":"ARRAY","array_element_type":{"code":"DATE"}}', "record", "ARRAY of DATE"),
        ('{"code":"WHAT"}', "record", "unknown")]


@query(_values(_DDL, "type_text, dialect, type_code"))
def column_types(spark, sf_dir):
    """Types from DDL text in both dialects, and from the type JSON that records carry."""

    def code(text: str, dialect: str) -> str:
        try:
            t = parse_type_json(text) if dialect == "record" else parse_ddl(text, dialect)
        except ValueError:
            return "unknown"
        return f"ARRAY of {t.element.code}" if t.code == "ARRAY" else t.code

    return spark.createDataFrame([(t, d, code(t, d)) for t, d, _ in _DDL], "type_text string, dialect string, type_code string")


@query("""SELECT event_id, 'user_id' AS column_name, 'INT64' AS type_code, true AS is_key, CAST(1 AS BIGINT) AS ordinal FROM changes UNION ALL SELECT event_id, 'value', 'FLOAT64', false, 2 FROM changes""")
def record_column_types(spark, sf_dir):
    """The column metadata that a record brings with it."""
    c = fixture(spark, sf_dir, "changes")
    col = lambda n, code, key, i: F.struct(F.lit(n).alias("name"), F.lit(json.dumps({"code": code})).alias("type"), F.lit(key).alias("is_primary_key"), F.lit(i).alias("ordinal_position"))
    types = F.array(col("user_id", "INT64", True, 1), col("value", "FLOAT64", False, 2))
    record = F.struct(F.struct(F.lit("2024-01-01T00:00:00Z").alias("commit_timestamp"), "record_sequence", F.col("txn_id").alias("server_transaction_id"), "table_name", types.alias("column_types"), "mod_type",
                               F.col("capture_type").alias("value_capture_type")).alias("data_change_record"))
    r = decode.decode_json(c.select("partition_token", F.to_json(record).alias("record")))
    r = r.select(_event_id().alias("event_id"), F.explode("data.column_types").alias("t"))
    return r.select("event_id", F.col("t.name").alias("column_name"), F.get_json_object("t.type", "$.code").alias("type_code"), F.col("t.is_primary_key").alias("is_key"), F.col("t.ordinal_position").alias("ordinal"))


# ---------------------------------------------------------------- scalars


@query(f"""SELECT token, {NOW_US // 1000} - offset_us // 1000 > 300000 + 60000 AS lags, {NOW_US // 1000} - offset_us // 1000 AS lag_ms FROM offsets WHERE offset_us IS NOT NULL""")
def offset_lags(spark, sf_dir):
    o = fixture(spark, sf_dir, "offsets").where("offset_us IS NOT NULL")
    now = F.lit(NOW_US // 1000)
    at = F.floor(F.col("offset_us") / 1000).cast("long")
    return o.select("token", scalars.lags_too_much(at, now, F.lit(300_000)).alias("lags"), scalars.offset_lag(F.col("offset_us"), now).alias("lag_ms"))


@query("""SELECT token, 'cdc_task-' || right(task_uid, 1) || '_' || token AS uid, '{' || chr(10) || '  "token" : "' || token || '",' || chr(10) || '  "state_ord" : ' || state_ord || chr(10) || '}' AS state FROM partitions""")
def task_uids_and_states(spark, sf_dir):
    p = fixture(spark, sf_dir, "partitions")
    return p.select("token", scalars.task_uid(F.lit("cdc"), F.substr("task_uid", F.lit(5)).cast("int"), F.col("token")).alias("uid"), scalars.pretty(F.struct("token", "state_ord")).alias("state"))


@query("""SELECT event_type, CASE event_type WHEN 'error' THEN 'fatal' WHEN 'view' THEN 'fatal' ELSE 'retriable' END AS class, count(*) AS n FROM events GROUP BY ALL""")
def error_classes(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type")
    code = F.when(F.col("event_type") == "error", "OUT_OF_RANGE").when(F.col("event_type") != "view", "ABORTED")
    return e.select("event_type", scalars.error_class(code).alias("class")).groupBy("event_type", "class").agg(F.count("*").alias("n"))


_BEYOND = [("y", "z"), ("az", "ba"), ("zz", "zza"), ("zzzzzzzz", "zzzzzzzza"), ("zzzzzzzza", "zzzzzzzzb"), ("aaaaaaaz", "aaaaaaba")]


@query(_values(_BEYOND, "uid, next_uid"))
def uid_successors(spark, sf_dir):
    return spark.createDataFrame([(u, scalars.successor(u)) for u, _ in _BEYOND], "uid string, next_uid string")


@query("SELECT rank, repeat('z', CAST(8 + rank // 26 AS INTEGER)) || chr(CAST(97 + rank % 26 AS INTEGER)) AS uid FROM (SELECT event_id AS rank FROM events) r")
def uids_beyond_eight_letters(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("rank"))
    return e.select("rank", scalars.record_uid(F.col("rank") + 26**8).alias("uid"))


# ---------------------------------------------------------------- sources and streams


@query("""SELECT 'range' AS part, partition_token, commit_us FROM changes WHERE commit_us BETWEEN (SELECT min(commit_us) + 86400000000 FROM changes) AND (SELECT max(commit_us) - 86400000000 FROM changes)
UNION ALL SELECT 'tokens', partition_token, commit_us FROM changes WHERE user_id % 8 IN (1, 2) UNION ALL SELECT 'root', NULL, commit_us FROM changes WHERE user_id % 8 = 3""")
def scan_bounds(spark, sf_dir):
    """The log by times, by tokens, and the records without a token that the root's stands for."""
    path = workdir(spark)
    w = wire(spark, sf_dir)
    w.withColumn("partition_token", F.when(F.col("partition_token") != "p3", F.col("partition_token"))).write.parquet(f"{path}/bare")
    w.write.parquet(f"{path}/log")
    lo, hi = w.agg(F.min("commit_us"), F.max("commit_us")).first()
    part = lambda name, t: t.select(F.lit(name).alias("part"), "partition_token", "commit_us")
    whole = part("range", change_stream.scan(spark, f"{path}/log", lo + 86_400_000_000, hi - 86_400_000_000))
    some = part("tokens", change_stream.scan(spark, f"{path}/log", tokens=["p1", "p2"]))
    return whole.union(some).union(part("root", change_stream.scan(spark, f"{path}/bare", tokens=[decode.ROOT])))


_IN_TOPIC = "'cdc.' || table_name AS topic, user_id, CASE mod_type WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END AS op, commit_us AS ts_us"


@query(f"SELECT {_IN_TOPIC} FROM changes")
def stream_equals_batch(spark, sf_dir):
    """The log as a stream in two runs from one checkpoint, through the sink: partitions p0 to p3 bring their second half only after the
    others went to their end."""
    path = workdir(spark)
    change_stream.register(spark)
    w = wire(spark, sf_dir)
    half = F.col("partition_token").isin("p4", "p5", "p6", "p7") | (F.col("commit_us") <= w.select(F.percentile("commit_us", 0.5).cast("long")).first()[0])
    for part in (w.where(half), w.where(~half)):
        part.write.mode("append").parquet(f"{path}/log")
        stream = spark.readStream.format("tidemark_changes").option("path", f"{path}/log").load()
        e = envelope.envelope(envelope.explode_mods(decode.decode_json(stream)), USERS, ["user_id"], STREAM)
        q = sink.run(e.select("topic", "key", "op", "ts_us"), f"{path}/out", f"{path}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return sink.read(spark, f"{path}/out").select("topic", "key.user_id", "op", "ts_us")


@query("SELECT partition_token AS token, event_id, batch FROM (SELECT *, event_id % 3 AS batch FROM changes) WHERE table_name = 'users'")
def acknowledged_records(spark, sf_dir):
    """What a sink has committed, batch by batch; the second batch is written twice, as after a failure."""
    path = workdir(spark)
    m = mods(spark, sf_dir, include="users").withColumn("event_id", _event_id())
    e = envelope.envelope(m, USERS, ["user_id"], STREAM).select("topic", "op", "partition_token", "event_id", scalars.record_uid(F.col("event_id")).alias("record_uid"))
    e, write = cut(e), sink.write_batch(path)
    for batch in (0, 1, 1, 2):
        write(e.where(F.col("event_id") % 3 == batch), batch)
    value = sum((F.instr(F.lit(scalars.UID_LETTERS), F.substr("uid", F.lit(i + 1), F.lit(1))) - 1).cast("long") * 26 ** (7 - i) for i in range(8))
    return sink.acknowledged(path, spark).select("token", value.alias("event_id"), F.col("batch").cast("long").alias("batch"))


@query(f"""SELECT CAST(b AS INTEGER) AS batch_id, low + b * 1000 AS low_watermark_us FROM (SELECT range AS b FROM range(0, 3)) x,
(SELECT min(start_us) AS low FROM partitions WHERE kind = 'owned' AND state_ord NOT IN (4, 5) OR kind = 'shared') y""")
def watermark_per_batch(spark, sf_dir):
    """The low watermark that the stream's batches leave behind while positions advance; one batch runs twice."""
    path = workdir(spark)
    p, at = fixture(spark, sf_dir, "partitions"), [0]
    write = sink.watermark_batch(lambda: p, lambda: p.select("token", (F.col("start_us") + at[0] * 1000).alias("offset_us")), path)
    for batch in (0, 1, 1, 2):
        at[0] = batch
        write(p, batch)
    return spark.read.parquet(f"{path}/batch=*").select("batch_id", "low_watermark_us")


# ---------------------------------------------------------------- a task's operations

@query("""WITH known AS (SELECT * FROM claims WHERE state_ord < 3), p AS (SELECT token, min(parent) AS priority, count(*) AS n FROM edges GROUP BY token),
fresh AS (SELECT e.token, min(e.parent) AS origin FROM edges e JOIN p ON p.token = e.token WHERE (n < 2 OR e.parent = priority) AND e.token NOT IN (SELECT token FROM known) GROUP BY e.token),
held AS (SELECT task_uid, token FROM known WHERE kind = 'owned' AND state_ord NOT IN (4, 5) UNION SELECT assignee, token FROM known WHERE kind = 'shared' AND assignee IS NOT NULL),
loads AS (SELECT t.task_uid, count(token) AS load FROM (SELECT DISTINCT task_uid FROM known) t LEFT JOIN held ON held.task_uid = t.task_uid GROUP BY t.task_uid),
places AS (SELECT task_uid, row_number() OVER (ORDER BY load + k, task_uid <> 'task3', task_uid) AS n FROM loads, (SELECT range AS k FROM range(0, 200000)) WHERE k < (SELECT count(*) FROM fresh)),
given AS (SELECT f.token, origin, task_uid AS assignee FROM (SELECT *, row_number() OVER (ORDER BY token) AS n FROM fresh) f JOIN places ON places.n = f.n)
SELECT token, origin, assignee, CASE WHEN assignee = 'task3' THEN 'owned' ELSE 'shared' END AS kind, CAST(0 AS BIGINT) AS state_ord FROM given""")
def register_children(spark, sf_dir):
    e, c = fixture(spark, sf_dir, "edges"), fixture(spark, sf_dir, "claims").where("state_ord < 3")
    return operations.children_registered(c, e.select("token", F.col("parent").alias("origin")), e, "task3")


@query("""WITH r AS (SELECT token FROM claims c WHERE task_uid = 'task1' AND kind = 'owned' AND state_ord = 1 AND NOT EXISTS (SELECT 1 FROM claims o WHERE o.token = c.token AND o.task_uid <> c.task_uid AND o.state_ord >= 2))
SELECT token, CAST(CASE WHEN row_number() OVER (ORDER BY token) <= 50 THEN 2 ELSE 1 END AS BIGINT) AS state_ord FROM r""")
def schedule_partitions(spark, sf_dir):
    return operations.scheduled(fixture(spark, sf_dir, "claims"), "task1", 50)


@query(f"""SELECT DISTINCT token, CAST(5 AS BIGINT) AS state_ord, CAST(NULL AS BIGINT) AS offset_us FROM partitions WHERE state_ord = 4 AND finished_us + 7200000000 <= {NOW_US}
AND token NOT IN (SELECT parent FROM edges e JOIN partitions c ON c.token = e.token WHERE c.state_ord NOT IN (4, 5))""")
def retire_partitions(spark, sf_dir):
    return operations.retired(fixture(spark, sf_dir, "partitions"), fixture(spark, sf_dir, "edges"), NOW_US)


@query("""WITH u AS (SELECT user_id, max(event_id) AS r, max(CASE WHEN publish_ms IS NOT NULL THEN event_id END) AS a FROM changes GROUP BY user_id),
f AS (SELECT user_id, user_id % 3 <> 2 AS told, user_id % 3 <> 2 AND coalesce(a = r, false) AS done FROM u)
SELECT 'u' || user_id AS token, CAST(CASE WHEN done THEN 4 WHEN user_id % 7 = 0 THEN 1 ELSE 3 END AS BIGINT) AS state, told AND NOT done AND user_id % 7 <> 0 AS pending FROM f""")
def lifecycle_states(spark, sf_dir):
    """A partition for each user: created, running, its records and their acknowledgements, told to finish (two of three), failed (one of seven)."""
    c = fixture(spark, sf_dir, "changes").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("token"), "user_id", "event_id", "commit_us", "publish_ms")
    uid = F.lpad(F.col("event_id").cast("string"), 19, "0")
    event = lambda t, kind, u, at: t.select("token", F.lit(0).cast("long").alias("seq"), F.lit(kind).alias("kind"), u.alias("uid"), at.cast("long").alias("at_us"))
    users, none = c.select("token", "user_id").distinct(), F.lit(None).cast("string")
    events = event(users, "created", none, F.lit(0)).union(event(users, "running", none, F.lit(1)))
    events = events.union(event(c, "record", uid, F.col("commit_us"))).union(event(c.where("publish_ms IS NOT NULL"), "ack", uid, F.col("commit_us") + 1))
    events = events.union(event(users.where("user_id % 3 <> 2"), "finish", none, F.lit(4 * 10**18))).union(event(users.where("user_id % 7 = 0"), "error", none, F.lit(5 * 10**18)))
    return lifecycle.lifecycle_batch(events).select("token", "state", "pending")


@query(f"SELECT token FROM partitions WHERE {BASE_US + 5_000_000_000} - {_LAST} > 300000000")
def overdue_finishing(spark, sf_dir):
    p = fixture(spark, sf_dir, "partitions").select("token", F.expr(_LAST).alias("since_us"))
    return lifecycle.overdue(p, BASE_US + 5_000_000_000).select("token")


@query("SELECT DISTINCT token FROM claims")
def every_token(spark, sf_dir):
    return ownership.all_tokens(fixture(spark, sf_dir, "claims"))


@query(_values([("all", "user_id,value"), ("none", "user_id"), ("value", "user_id,value")], "chosen, columns"))
def watched_columns(spark, sf_dir):
    cases = [("all", None), ("none", []), ("value", ["value"])]
    return spark.createDataFrame([(n, ",".join(envelope.watched(USERS, ["user_id"], c))) for n, c in cases], "chosen string, columns string")


# ---------------------------------------------------------------- the log of tasks


@query("SELECT log_offset, generation FROM sync_log WHERE generation >= 3 AND generation >= 4")
def stale_rebalances(spark, sf_dir):
    return syncfold.current_rebalances(fixture(spark, sf_dir, "sync_log").select("log_offset", "generation"), 3, 4)


@query("SELECT state_ts // 60 AS slot, max(log_offset) AS epoch_offset FROM sync_log WHERE message_type IN ('NEW_EPOCH', 'UPDATE_EPOCH') GROUP BY ALL")
def epoch_offset_refresh(spark, sf_dir):
    """state_ts counts steps of five seconds: 60 of them are the 300 seconds between two refreshes."""
    return syncfold.epoch_offsets(fixture(spark, sf_dir, "sync_log"), 60, "state_ts")


@query("SELECT log_offset, task_uid, consumer_id, message_type, generation, state_ts FROM sync_log WHERE log_offset >= 100")
def sync_wire_roundtrip(spark, sf_dir):
    """The log in two appends, published as text and read from an offset."""
    path, log = workdir(spark), fixture(spark, sf_dir, "sync_log")
    syncfold.publish(log.where("log_offset < 500"), path)
    syncfold.publish(log.where("log_offset >= 500"), path)
    return syncfold.from_wire(syncfold.from_offset(spark.read.parquet(path), 100))


@query("SELECT generation, consumer_id FROM (SELECT DISTINCT generation, consumer_id, CAST(substr(consumer_id, 9) AS INTEGER) AS p FROM sync_log) WHERE p = 0")
def generation_leaders(spark, sf_dir):
    a = fixture(spark, sf_dir, "sync_log").select("generation", "consumer_id", F.substr("consumer_id", F.lit(9)).cast("int").alias("partition")).distinct()
    return rebalance.leader(a)


@query("""WITH s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_uid ORDER BY state_ts DESC, log_offset) AS n FROM sync_log) WHERE n = 1)
SELECT 'new epoch' AS part, task_uid, log_offset FROM s WHERE task_uid <> 'task5' UNION ALL SELECT 'survivors', task_uid, log_offset FROM s WHERE task_uid IN ('task1', 'task2')
UNION ALL SELECT 'gone', task_uid, log_offset FROM s WHERE task_uid NOT IN ('task1', 'task2')""")
def epoch_states(spark, sf_dir):
    s = syncfold.latest_states(fixture(spark, sf_dir, "sync_log"))
    alive = spark.createDataFrame([("task1",), ("task2",)], "task_uid string")
    one = lambda name, t: t.select(F.lit(name).alias("part"), "task_uid", "log_offset")
    stay, gone = syncfold.split_epoch(s, alive)
    return one("new epoch", syncfold.new_epoch_states(s, "task5")).union(one("survivors", stay)).union(one("gone", gone))


@query("SELECT upto, upto >= (SELECT min(log_offset) FROM sync_log WHERE message_type IN ('NEW_EPOCH', 'UPDATE_EPOCH')) AS ready FROM (SELECT unnest([CAST(-1 AS BIGINT), 0, 5, 100]) AS upto) u")
def start_gate(spark, sf_dir):
    log = fixture(spark, sf_dir, "sync_log")
    return spark.createDataFrame([(n, syncfold.initialised(log, n)) for n in (-1, 0, 5, 100)], "upto long, ready boolean")


@query("""WITH RECURSIVE m AS (SELECT log_offset, CASE WHEN log_offset = (SELECT min(log_offset) FROM sync_log) THEN 2 ELSE least(20, greatest(2, log_offset % 9)) END AS start, log_offset % 50 AS work, log_offset % 7 AS idle FROM sync_log
  WHERE message_type = 'UPDATE_EPOCH' OR log_offset = (SELECT min(log_offset) FROM sync_log)),
s AS (SELECT log_offset, CAST(start AS INTEGER) AS t, work, idle FROM m UNION ALL SELECT log_offset, least(20, t + CAST(ceil(t * 0.2) AS INTEGER)), work, idle FROM s WHERE work > t * 2 AND t < 20),
f AS (SELECT log_offset, max(t) AS t, any_value(work) AS work, any_value(idle) AS idle FROM s GROUP BY log_offset)
SELECT log_offset, CAST(CASE WHEN t > 2 AND work < 2 * t AND 2 * idle > t THEN greatest(2, t // 2) ELSE t END AS INTEGER) AS required FROM f""")
def autoscale_loop(spark, sf_dir):
    """How many tasks each message asks for: the first, and then those that update the epoch."""
    log = fixture(spark, sf_dir, "sync_log").select("log_offset", "message_type", (F.col("log_offset") % 9).cast("int").alias("tasks"), (F.col("log_offset") % 50).alias("in_work"), (F.col("log_offset") % 7).alias("idle"))
    return metrics.autoscale(log, 2, 2, 20)


@query("""SELECT table_name, count(*) AS buckets, CAST(sum(n) AS BIGINT) AS values FROM (SELECT table_name, CASE WHEN value > 0 THEN ceil(ln(value) / ln(1.01 / 0.99)) END AS b, count(*) AS n FROM changes WHERE value IS NOT NULL GROUP BY ALL) GROUP BY ALL""")
def quantile_sketches_add_up(spark, sf_dir):
    """Sketches of the halves of a table, added, are the whole's."""
    c = fixture(spark, sf_dir, "changes")
    parts = [metrics.sketch(c.where(f"event_id % 2 = {k}"), "value", "table_name") for k in (0, 1)]
    whole = parts[0].union(parts[1]).groupBy("table_name", "bucket").agg(F.sum("n").alias("n"))
    return whole.groupBy("table_name").agg(F.count("*").alias("buckets"), F.sum("n").alias("values"))
