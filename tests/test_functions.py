"""Types, scalars and settings."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars
from tidemark.functions.types import ColumnType, coerce, parse_ddl, parse_type_json, spark_type
from tidemark.plans.config import ConfigError, ReaderConfig


@pytest.mark.parametrize(
    ("text", "dialect", "code"),
    [("int64", "google", "INT64"), ("STRING(100)", "google", "STRING"), ("Bytes(MAX)", "google", "BYTES"), ("TOKENLIST", "google", "TOKENLIST"), ("bigint", "postgres", "INT64"),
     ("character varying(5)", "postgres", "STRING"), ("text", "postgres", "STRING"), ("timestamp  with time zone", "postgres", "TIMESTAMP"), ("numeric(3)", "postgres", "NUMERIC"),
     ("db.commit_timestamp", "postgres", "TIMESTAMP"), ("double precision", "postgres", "FLOAT64"), ("uuid", "google", "UUID")],
)
def test_ddl(text, dialect, code):
    assert parse_ddl(text, dialect) == ColumnType(code)


def test_ddl_arrays():
    assert parse_ddl("ARRAY<STRING(MAX)>") == ColumnType("ARRAY", ColumnType("STRING"))
    assert parse_ddl("bigint[]", "postgres") == ColumnType("ARRAY", ColumnType("INT64"))
    assert spark_type(parse_ddl("array<float32>")) == T.ArrayType(T.FloatType(), True)


@pytest.mark.parametrize(("text", "dialect"), [("STRUCT<a INT64>", "google"), ("int", "postgres"), ("INT64", "mysql"), ("", "google")])
def test_ddl_unknown(text, dialect):
    with pytest.raises(ValueError):
        parse_ddl(text, dialect)


def test_refused_types():
    for t in (ColumnType("STRUCT"), ColumnType("ARRAY", ColumnType("ARRAY", ColumnType("BOOL")))):
        with pytest.raises(ValueError):
            spark_type(t)


def test_type_json():
    assert parse_type_json('{"code":"ARRAY","array_element_type":{"code":"FLOAT64"}}') == ColumnType("ARRAY", ColumnType("FLOAT64"))
    with pytest.raises(ValueError):
        parse_type_json('{"code":"X"}')


def test_coercion(spark):
    t = spark.createDataFrame([('[1.1, 2, 3.4]', "dGVzdA==", "9007199254740993", "x")], "a string, b string, i string, z string")
    r = t.select(
        coerce(F.col("a"), ColumnType("ARRAY", ColumnType("FLOAT64"))).alias("a"), coerce(F.col("b"), ColumnType("BYTES")).alias("b"), coerce(F.col("i"), ColumnType("INT64")).alias("i"),
        coerce(F.col("z"), ColumnType("INT64")).alias("z"), coerce(F.col("z"), ColumnType("INT64"), lenient=False).alias("strict"), coerce(F.lit(None).cast("string"), ColumnType("INT64")).alias("null"),
    ).first()
    assert (r["a"], bytes(r["b"]), r["i"], r["z"], r["strict"], r["null"]) == ([1.1, 2.0, 3.4], b"test", 9007199254740993, 0, None, None)


@given(st.integers(0, 26**5))
@settings(max_examples=50)
def test_successor_is_next_rank(n):
    def uid(k):
        return "".join(chr(97 + k // 26**p % 26) for p in range(7, -1, -1))

    assert scalars.successor(uid(n)) == uid(n + 1)


def test_successor_appends():
    assert scalars.successor("zz") == "zza"
    assert scalars.successor("az") == "ba"


def test_record_uid(spark):
    whole = 26**8
    t = spark.createDataFrame([(n,) for n in (0, 1, 26, 700, whole - 1, whole, whole + 25, whole + 26, whole + 60)], "n long")
    got = [r[0] for r in t.select(scalars.record_uid(F.col("n"))).collect()]
    assert got[:4] == ["aaaaaaaa", "aaaaaaab", "aaaaaaba", "aaaaabay"]
    uid, want = "z" * 8, []
    for n in range(61):
        uid = scalars.successor(uid)
        if n in (0, 25, 26, 60):
            want.append(uid)
    assert got[4:] == ["z" * 8, *want]


def test_times_keep_nanoseconds(spark):
    t = spark.createDataFrame([("1970-01-01T00:00:10.000000020Z",), ("2024-02-29T23:59:59Z",), (None,)], "t string")
    rows = t.select(scalars.order_key(F.col("t")).alias("k"), scalars.epoch_millis(F.col("t")).alias("ms")).collect()
    assert (rows[0]["k"]["sec"], rows[0]["k"]["nanos"], rows[0]["ms"]) == (10, 20, 10_000)
    assert rows[1]["k"]["nanos"] == 0 and rows[2]["ms"] is None


def test_error_class(spark):
    t = spark.createDataFrame([("OUT_OF_RANGE",), ("ABORTED",), (None,)], "c string")
    assert [r[0] for r in t.select(scalars.error_class(F.col("c"))).collect()] == ["fatal", "retriable", "fatal"]


GOOD = {"database": "d", "stream": "s", "project": "p", "instance": "i"}


@pytest.mark.parametrize(
    "bad",
    [{"heartbeat_ms": "99"}, {"heartbeat_ms": "300001"}, {"database": " "}, {"start": "yesterday"}, {"start": "2024-01-02T00:00:00Z", "end": "2024-01-01T00:00:00Z"},
     {"capture_mode": "ALL"}, {"credentials_path": "/nowhere"}, {"credentials_json": "{"}, {"project": ""}, {"kind": "omni"}, {"host": "a", "emulator_host": "b"}, {"nonsense": "1"},
     {"kind": "omni", "host": "h", "plaintext": "true", "ca_cert": "c"}, {"kind": "omni", "host": "h", "client_cert": "c"}, {"plaintext": "maybe"}, {"max_tasks": "x"}],
)
def test_bad_settings(bad):
    with pytest.raises(ConfigError):
        ReaderConfig.of({**GOOD, **bad})


def test_good_settings():
    c = ReaderConfig.of({**GOOD, "heartbeat_ms": "100", "start": "2024-01-01T00:00:00.123456789Z", "end": "2024-01-01T00:00:00.2Z", "low_watermark": "true"})
    assert c.heartbeat_ms == 100 and c.low_watermark
