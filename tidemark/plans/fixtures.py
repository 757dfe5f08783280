"""Change-stream tables made from the TPC-H-like ones: one SQL text for Spark and DuckDB.

US(x) is a timestamp's microseconds, DIV(a, b) whole division, IDS(a) a table of id from a on, as many as there are events: so
partitions, their lineage, claims and offsets grow with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Microseconds at which the lineage fixture begins, and at which queries take now to be.
BASE_US, NOW_US = 1_700_000_000_000_000, 1_706_745_600_000_000

CHANGES = """
SELECT event_id, concat('p', CAST(user_id % 8 AS STRING)) AS partition_token, US(ts) AS commit_us, event_id % 1000 AS commit_nanos,
  concat('tx', CAST(DIV(event_id, 4) AS STRING)) AS txn_id, lpad(CAST(event_id % 4 AS STRING), 8, '0') AS record_sequence,
  CASE user_id % 3 WHEN 0 THEN 'users' WHEN 1 THEN 'orders_cdc' ELSE 'audit' END AS table_name,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS mod_type,
  CASE event_id % 4 WHEN 0 THEN 'OLD_AND_NEW_VALUES' WHEN 1 THEN 'NEW_ROW' WHEN 2 THEN 'NEW_VALUES' ELSE 'NEW_ROW_AND_OLD_VALUES' END AS capture_type,
  user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS old_value,
  count(*) OVER (PARTITION BY DIV(event_id, 4)) AS n_records,
  row_number() OVER (PARTITION BY DIV(event_id, 4), user_id % 8 ORDER BY event_id DESC) = 1 AS is_last,
  US(ts) // 1000 AS commit_ms, US(ts) // 1000 + event_id % 7 AS read_ms, US(ts) // 1000 + event_id % 7 + event_id % 11 AS emit_ms,
  US(ts) // 1000 + event_id % 7 + event_id % 11 + event_id % 13 AS poll_ms,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE US(ts) // 1000 + event_id % 7 + event_id % 11 + event_id % 13 + event_id % 17 END AS publish_ms
FROM events"""

PARTITIONS = f"""
SELECT concat('task', CAST(id % 5 AS STRING)) AS task_uid, CASE WHEN id % 7 = 0 THEN 'shared' ELSE 'owned' END AS kind,
  concat('n', CAST(id AS STRING)) AS token, CAST(id % 6 AS BIGINT) AS state_ord, {BASE_US} + id * 1000000 AS start_us,
  CASE WHEN id % 6 >= 4 THEN {BASE_US} + id * 2000000 END AS finished_us,
  CASE WHEN id % 7 = 0 THEN concat('task', CAST((id + 1) % 6 AS STRING)) END AS assignee
FROM IDS(1)"""

EDGES = """
SELECT concat('n', CAST(id AS STRING)) AS token, concat('n', CAST(DIV(id, 2) AS STRING)) AS parent FROM IDS(2)
UNION ALL SELECT concat('n', CAST(id AS STRING)) AS token, concat('n', CAST(DIV(id, 2) + 1 AS STRING)) AS parent FROM IDS(2) WHERE id % 5 = 0"""

#: A few partitions that two tasks claim, as after a split brain.
CLAIMS = f"""
SELECT * FROM ({PARTITIONS}) q WHERE true UNION ALL
SELECT concat('task', CAST((id + 2) % 5 AS STRING)), 'shared', concat('n', CAST(id AS STRING)), CAST((id + 1) % 6 AS BIGINT), {BASE_US} + id * 1000000, NULL,
  concat('task', CAST(id % 4 AS STRING)) FROM IDS(1) WHERE id % 11 = 0"""

OFFSETS = f"""
SELECT concat('n', CAST(id AS STRING)) AS token, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN {BASE_US} + id * 1000000 - 1000000 ELSE {BASE_US} + id * 1000000 + id * 1000 END AS offset_us
FROM IDS(1) WHERE id % 9 <> 0"""

SYNC = """
SELECT event_id AS log_offset, concat('task', CAST(user_id % 64 AS STRING)) AS task_uid, concat('consumer', CAST(user_id % 64 AS STRING)) AS consumer_id,
  CASE event_type WHEN 'signup' THEN 'NEW_EPOCH' WHEN 'error' THEN 'UPDATE_EPOCH' WHEN 'purchase' THEN 'REBALANCE_ANSWER' ELSE 'REGULAR' END AS message_type,
  DIV(event_id, 1000) - event_id % 3 AS generation, DIV(US(ts), 5000000) - event_id % 7 AS state_ts
FROM events"""

STREAMS = """
SELECT * FROM (VALUES ('s1', false, 'users', false, 'name'), ('s1', false, 'users', false, 'value'), ('s1', false, 'orders_cdc', true, CAST(NULL AS STRING)),
  ('s2', true, CAST(NULL AS STRING), CAST(NULL AS BOOLEAN), CAST(NULL AS STRING)), ('s3', false, CAST(NULL AS STRING), CAST(NULL AS BOOLEAN), CAST(NULL AS STRING)))
  AS t(stream, all_tables, table_name, all_columns, column_name)"""

SCHEMAS = """
SELECT * FROM (VALUES ('users', 'user_id', 'INT64', 1, false, 0), ('users', 'value', 'FLOAT64', 2, true, 0), ('users', 'name', 'STRING(MAX)', 3, true, 0),
  ('users', 'user_id', 'INT64', 1, false, 1706000000000000), ('users', 'value', 'NUMERIC', 2, true, 1706000000000000), ('users', 'born', 'DATE', 3, true, 1706000000000000),
  ('orders_cdc', 'user_id', 'INT64', 1, false, 0), ('orders_cdc', 'value', 'FLOAT64', 2, true, 0), ('audit', 'user_id', 'INT64', 1, false, 0),
  ('audit', 'user_id', 'INT64', 1, false, 1706000000000000), ('audit', 'value', 'FLOAT64', 2, true, 1706000000000000), ('gone', 'id', 'INT64', 1, false, 0))
  AS t(table_name, column_name, type_text, ordinal, nullable, valid_from)"""

KEYS = """
SELECT * FROM (VALUES ('users', 'user_id', 'PRIMARY_KEY'), ('orders_cdc', 'user_id', 'PRIMARY_KEY'), ('audit', 'user_id', 'PRIMARY_KEY'), ('users', 'name', 'by_name'))
  AS t(table_name, column_name, index_name)"""

ALL = {"changes": CHANGES, "partitions": PARTITIONS, "edges": EDGES, "claims": CLAIMS, "offsets": OFFSETS, "sync_log": SYNC, "streams": STREAMS, "schemas": SCHEMAS, "key_columns": KEYS}


def _ids(sql: str) -> str:
    return re.sub(r"\bIDS\((\d+)\)", r"(SELECT event_id + 1 AS id FROM events WHERE event_id + 1 >= \1) ids", sql)


def for_duckdb(sql: str) -> str:
    sql = re.sub(r"\bUS\(", "epoch_us(", sql)
    sql = _ids(sql)
    return re.sub(r"\bDIV\(((?:[^(),]|\([^()]*\))+), (\d+)\)", r"((\1) // \2)", sql)


def for_spark(sql: str) -> str:
    sql = re.sub(r"\bUS\((\w+)\)", r"unix_micros(CAST(\1 AS TIMESTAMP))", sql)
    sql = _ids(sql)
    sql = re.sub(r"\bDIV\(((?:[^(),]|\([^()]*\)|\((?:[^()]|\([^()]*\))*\))+), (\d+)\)", r"((\1) div \2)", sql)
    return sql.replace(" // 1000", " div 1000")


def oracle(sql: str) -> str:
    """A DuckDB query over the fixtures' names: those it mentions become its first common tables."""
    used = [n for n in ALL if re.search(rf"\b{n}\b", sql)]
    ctes = ", ".join(f"{n} AS ({for_duckdb(ALL[n])})" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {body[14:]}" if ctes else body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}" if ctes else body
    return f"WITH {ctes} {body}" if ctes else body


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a DataFrame. Times are microseconds since 1970 in UTC, so the session's zone is set to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sql = for_spark(ALL[name])
    if "FROM events" in sql:
        return spark.sql(sql.replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    return spark.sql(sql)
