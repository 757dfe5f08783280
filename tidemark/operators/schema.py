"""Table schemas as tables: scans of the catalog, stream definitions, key lookup, merging, versions, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import parse_ddl, spark_type


def columns_scan(columns: DataFrame, tables: list[str] | None = None, dialect: str = "google") -> DataFrame:
    """The catalog's columns, of the listed tables if any; postgres has its own schema name."""
    out = columns if "table_schema" not in columns.columns else columns.where(F.col("table_schema") == ("" if dialect == "google" else "public"))
    return out.where(F.col("table_name").isin(tables)) if tables else out


def key_scan(index_columns: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """table_name and column_name of the primary keys."""
    out = index_columns.where("index_name = 'PRIMARY_KEY'")
    return (out.where(F.col("table_name").isin(tables)) if tables else out).select("table_name", "column_name")


def stream_exists(streams: DataFrame, name: str, dialect: str = "google") -> bool:
    name = name.lower() if dialect == "postgres" else name
    return streams.where(F.col("stream") == name).limit(1).count() > 0


def mutable_ranges(options: DataFrame, stream: str) -> bool:
    """Whether a stream's partition_mode is MUTABLE_KEY_RANGE; options: stream, option_name, option_value."""
    found = options.where((F.col("stream") == stream) & (F.lower("option_name") == "partition_mode")).select("option_value").first()
    return bool(found) and str(found[0]).upper() == "MUTABLE_KEY_RANGE"


def stream_definition(streams: DataFrame, tables: DataFrame, columns: DataFrame) -> DataFrame:
    """stream, all_tables, table_name, all_columns, columns (sorted): left joins all the way, so a stream without tables stays.

    streams: stream, all_tables; tables: stream, table_name, all_columns; columns: stream, table_name, column_name.
    """
    joined = streams.join(tables, "stream", "left").join(columns, ["stream", "table_name"], "left")
    return joined.groupBy("stream", "all_tables", "table_name", "all_columns").agg(F.sort_array(F.collect_set("column_name")).alias("columns"))


def with_keys(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """columns and is_primary_key."""
    k = keys.select("table_name", "column_name").distinct().withColumn("_k", F.lit(True))
    return columns.join(k, ["table_name", "column_name"], "left").withColumn("is_primary_key", F.coalesce("_k", F.lit(False))).drop("_k")


def as_of(schemas: DataFrame, at: Column | int) -> DataFrame:
    """The columns of each table's newest version whose valid_from is not after at."""
    old = schemas.where(F.col("valid_from") <= at)
    last = old.groupBy("table_name").agg(F.max("valid_from").alias("valid_from"))
    return old.join(last, ["table_name", "valid_from"])


def as_of_events(events: DataFrame, schemas: DataFrame, time: str) -> DataFrame:
    """events and schema_version: the valid_from of their table's newest version at their time, null before the first.

    Versions become an array of their table, small by nature, so that events are neither multiplied nor sorted.
    """
    versions = schemas.groupBy("table_name").agg(F.sort_array(F.collect_set("valid_from")).alias("_v"))
    out = events.join(versions, "table_name", "left")
    return out.withColumn("schema_version", F.array_max(F.filter("_v", lambda v: v <= F.col(time)))).drop("_v")


def merge(previous: DataFrame, new: DataFrame) -> DataFrame:
    """The merged schema: tables of new only; for a column in both the new one counts, dropped columns stay.

    Both: table_name, column_name and any others, the same in both.
    """
    rest = [c for c in new.columns if c not in ("table_name", "column_name")]
    kept = previous.join(new.select("table_name").distinct(), "table_name", "left_semi")
    n = new.select("table_name", "column_name", F.struct(*rest).alias("_n"))
    p = kept.select("table_name", "column_name", F.struct(*rest).alias("_p"))
    both = p.join(n, ["table_name", "column_name"], "full_outer").withColumn("_x", F.coalesce("_n", "_p"))
    return both.select("table_name", "column_name", *[F.col(f"_x.{c}").alias(c) for c in rest], F.col("_n").isNull().alias("retained"))


def validate(record_columns: DataFrame, schema: DataFrame, watched: DataFrame | None = None) -> DataFrame:
    """What of each table's record columns does not fit its schema: missing, unwatched or type. A key that is none, or the reverse, raises.

    All: table_name, column_name; the first two also type_text, is_primary_key; watched: the columns that the stream shows (without: all).
    """
    s = schema.select("table_name", "column_name", F.col("type_text").alias("_t"), F.col("is_primary_key").alias("_k"))
    r = record_columns.join(s, ["table_name", "column_name"], "left")
    if watched is not None:
        shown = watched.select("table_name", "column_name").distinct().withColumn("_w", F.lit(True))
        r = r.join(shown, ["table_name", "column_name"], "left")
    hidden = F.col("_w").isNull() if watched is not None else F.lit(False)
    wrong = F.raise_error(F.concat(F.lit("primary key data is incorrect: "), "table_name", F.lit("."), "column_name")).cast("string")
    problem = F.when(F.col("_t").isNull(), "missing").when(hidden, "unwatched").when(F.col("_k") != F.col("is_primary_key"), wrong).when(F.upper("_t") != F.upper("type_text"), "type")
    return r.select("table_name", "column_name", problem.alias("problem")).where("problem IS NOT NULL")


def projected(columns: DataFrame, definition: DataFrame, stream: str) -> DataFrame:
    """The columns that a stream shows: keys, and those it watches.

    columns: table_name, column_name, is_primary_key, ...; definition: what stream_definition returns.
    """
    d = definition.where(F.col("stream") == stream)
    every = d.where("all_tables").select(F.lit(True).alias("_every")).distinct()
    d = d.where("table_name IS NOT NULL").select("table_name", "all_columns", F.col("columns").alias("_c"))
    out = columns.join(d, "table_name", "left").join(F.broadcast(every), F.lit(True), "left")  # one row at most
    shown = F.coalesce("_every", F.lit(False)) | (F.col("all_columns").isNotNull() & (F.col("is_primary_key") | F.col("all_columns") | F.array_contains("_c", F.col("column_name"))))
    return out.where(shown).select(*columns.columns)


def struct_types(rows: list, dialect: str = "google") -> tuple[T.StructType | None, T.StructType]:
    """Key and value types of a table; rows: column_name, type_text, ordinal, nullable, is_primary_key.

    Keys are as nullable as declared, values where declared or no key; a table without keys has no key type.
    """
    ordered = sorted(rows, key=lambda r: r["ordinal"])
    kinds = {r["column_name"]: spark_type(parse_ddl(r["type_text"], dialect)) for r in ordered}
    keys = [T.StructField(r["column_name"], kinds[r["column_name"]], r["nullable"]) for r in ordered if r["is_primary_key"]]
    values = [T.StructField(r["column_name"], kinds[r["column_name"]], r["nullable"] or not r["is_primary_key"]) for r in ordered]
    return (T.StructType(keys) if keys else None), T.StructType(values)


class SchemaCache:
    """Types by table and version; a change of schema clears it."""

    def __init__(self, load):
        self.load, self.held = load, {}

    def of(self, table: str, version: int):
        if (table, version) not in self.held:
            self.held[table, version] = self.load(table, version)
        return self.held[table, version]

    def reset(self) -> None:
        self.held.clear()
