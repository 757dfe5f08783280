"""Column types of change records: DDL text in two dialects, record-embedded type JSON, Spark types, value coercion.

Values arrive as text out of JSON maps (64-bit integers are JSON strings). Coercion is lenient like the wire's: a JSON null is
null, anything else that does not parse is 0, 0.0 or false; strict coercion gives null instead.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type codes and what they are called in each dialect.
GOOGLE = {"BOOL": "BOOL", "INT64": "INT64", "FLOAT32": "FLOAT32", "FLOAT64": "FLOAT64", "TIMESTAMP": "TIMESTAMP", "DATE": "DATE",
          "NUMERIC": "NUMERIC", "JSON": "JSON", "TOKENLIST": "TOKENLIST", "UUID": "UUID"}
GOOGLE_PREFIX = {"STRING": "STRING", "BYTES": "BYTES"}
POSTGRES = {"BOOLEAN": "BOOL", "BIGINT": "INT64", "REAL": "FLOAT32", "DOUBLE PRECISION": "FLOAT64", "BYTEA": "BYTES",
            "TIMESTAMP WITH TIME ZONE": "TIMESTAMP", "DATE": "DATE", "JSONB": "JSON", "UUID": "UUID"}
POSTGRES_PREFIX = {"CHARACTER VARYING": "STRING", "TEXT": "STRING", "NUMERIC": "NUMERIC"}
#: Types whose values stay text in an envelope.
TEXTUAL = ("STRING", "TIMESTAMP", "DATE", "NUMERIC", "JSON", "TOKENLIST", "UUID")
CODES = ("BOOL", "INT64", "FLOAT32", "FLOAT64", "BYTES", "ARRAY", "STRUCT", *TEXTUAL)


@dataclass(frozen=True)
class ColumnType:
    code: str
    element: ColumnType | None = None


def parse_ddl(text: str, dialect: str = "google") -> ColumnType:
    """The type that DDL text names, whatever its case; arrays nest. Unknown text or dialect raises ValueError."""
    if dialect not in ("google", "postgres"):
        raise ValueError(f"unknown dialect: {dialect}")
    t = " ".join(text.upper().split())
    if dialect == "postgres":
        if t.endswith("[]"):
            return ColumnType("ARRAY", parse_ddl(t[:-2], dialect))
        if t.endswith(".COMMIT_TIMESTAMP"):
            return ColumnType("TIMESTAMP")
        exact, prefixes = POSTGRES, POSTGRES_PREFIX
    else:
        if t.startswith("ARRAY<") and t.endswith(">"):
            return ColumnType("ARRAY", parse_ddl(t[6:-1], dialect))
        exact, prefixes = GOOGLE, GOOGLE_PREFIX
    if t in exact:
        return ColumnType(exact[t])
    for p, code in prefixes.items():
        if t.startswith(p):
            return ColumnType(code)
    raise ValueError(f"unknown column type: {text}")


def parse_type_json(text: str) -> ColumnType:
    """The type of {"code": ..., "array_element_type": {...}} as records carry it."""

    def read(node: dict) -> ColumnType:
        code = str(node.get("code", "")).upper()
        if code not in CODES:
            raise ValueError(f"unknown type code: {node}")
        return ColumnType(code, read(node["array_element_type"]) if code == "ARRAY" else None)

    return read(json.loads(text))


def spark_type(t: ColumnType) -> T.DataType:
    """The type of such values in envelopes. Structs are refused; array elements may be null."""
    if t.code == "ARRAY":
        if t.element is None or t.element.code == "ARRAY":
            raise ValueError("arrays of arrays are not supported")
        return T.ArrayType(spark_type(t.element), True)
    if t.code in TEXTUAL:
        return T.StringType()
    found = {"BOOL": T.BooleanType(), "INT64": T.LongType(), "FLOAT32": T.FloatType(), "FLOAT64": T.DoubleType(), "BYTES": T.BinaryType()}.get(t.code)
    if found is None:
        raise ValueError(f"type {t.code} is not supported")
    return found


def coerce(value: Column, t: ColumnType, lenient: bool = True) -> Column:
    """A text value as a value of the type."""
    if t.code == "ARRAY":
        elements = F.from_json(value, "array<string>")
        return F.transform(elements, lambda e: coerce(e, t.element, lenient))
    kind = spark_type(t)
    if t.code in TEXTUAL:
        return value
    if t.code == "BYTES":
        return F.try_to_binary(value, F.lit("base64"))
    if t.code == "FLOAT32":
        got, zero = value.try_cast("double").cast("float"), F.lit(0.0).cast("float")
    elif t.code == "BOOL":
        got, zero = F.when(F.lower(value) == "true", True).when(F.lower(value) == "false", False), F.lit(False)
    elif t.code == "INT64":
        got = F.coalesce(value.try_cast("bigint"), value.try_cast("decimal(38,9)").try_cast("bigint"))
        zero = F.lit(0).cast("bigint")
    else:
        got, zero = value.try_cast(kind), F.lit(0.0)
    return F.when(value.isNotNull(), F.coalesce(got, zero)) if lenient else got
