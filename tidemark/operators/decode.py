"""Decoding change records: JSON text, nested structs and positional values become one table of records.

A record has record_type (data, heartbeat, child), the partition token it was read from, its rank among the records of its
row (data, then heartbeat, then child), and one struct for each kind, null but for its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The token of the partition that lists the first real ones.
ROOT = "Parent0"

# The wire's enumerations; anything else is UNKNOWN.
MOD_TYPES = ("INSERT", "UPDATE", "DELETE")
CAPTURE_TYPES = ("OLD_AND_NEW_VALUES", "NEW_ROW", "NEW_VALUES", "NEW_ROW_AND_OLD_VALUES")

MOD = "struct<keys:map<string,string>,old_values:map<string,string>,new_values:map<string,string>>"
DATA = (
    "struct<commit_timestamp:string,record_sequence:string,server_transaction_id:string,is_last_record_in_transaction_in_partition:boolean,"
    "table_name:string,column_types:array<struct<name:string,type:string,is_primary_key:boolean,ordinal_position:bigint>>,"
    f"mods:array<{MOD}>,mod_type:string,value_capture_type:string,number_of_records_in_transaction:bigint,"
    "number_of_partitions_in_transaction:bigint,transaction_tag:string,is_system_transaction:boolean>"
)
HEARTBEAT = "struct<timestamp:string>"
CHILD = "struct<start_timestamp:string,record_sequence:string,child_partitions:array<struct<token:string,parent_partition_tokens:array<string>>>>"
WIRE = f"struct<data_change_record:{DATA},heartbeat_record:{HEARTBEAT},child_partitions_record:{CHILD}>"

#: Fields without which a data record is no record.
MANDATORY = ("commit_timestamp", "record_sequence", "server_transaction_id", "table_name", "mod_type", "value_capture_type")


def known(value: Column, names: tuple[str, ...]) -> Column:
    """The value if it is one of names, else UNKNOWN; null is UNKNOWN too."""
    return F.when(value.isin(*names), value).otherwise("UNKNOWN")


def wire_dialect(dialect: str, mutable_ranges: bool = False) -> str:
    """The wire format of a stream: struct rows, or JSON text; the postgres dialect has no mutable key ranges."""
    if dialect not in ("google", "postgres"):
        raise ValueError(f"unknown dialect: {dialect}")
    if mutable_ranges and dialect == "postgres":
        raise ValueError("mutable key ranges cannot be read in the postgres dialect")
    return "nested" if dialect == "google" else "json"


def text_column(rows: DataFrame, name: str) -> Column:
    """A record column as JSON text: strings as they are, variants written out; any other type raises."""
    kind = rows.schema[name].dataType.simpleString()
    if kind not in ("string", "variant"):
        raise ValueError(f"no JSON text in a column of type {kind}: {name}")
    return F.col(name) if kind == "string" else F.to_json(F.col(name))


def decode(rows: DataFrame, dialect: str, mutable_ranges: bool = False, strict: bool = True) -> DataFrame:
    """Records of a stream in its dialect's wire format."""
    nested = wire_dialect(dialect, mutable_ranges) == "nested"
    return decode_nested(rows, strict=strict) if nested else decode_json(rows, strict=strict)


def decode_json(rows: DataFrame, record: str = "record", token: str = "partition_token", strict: bool = True) -> DataFrame:
    """Rows of JSON text (or variants): the first known kind of each counts. Null text is an empty object, a record of no kind.
    strict: an unknown kind or a missing field raises; else such rows have a null record_type."""
    rows = rows.withColumn(record, text_column(rows, record))
    # through a generator of one row: merged into later projections, the text would be parsed again for every field
    r = rows.select("*", F.explode(F.array(F.from_json(F.coalesce(F.col(record), F.lit("{}")), WIRE))).alias("_r"))
    data, beat, child = F.col("_r.data_change_record"), F.col("_r.heartbeat_record"), F.col("_r.child_partitions_record")
    kind = F.when(data.isNotNull(), "data").when(beat.isNotNull(), "heartbeat").when(child.isNotNull(), "child")
    if strict:
        kind = F.coalesce(kind, F.raise_error(F.concat(F.lit("no known record kind: "), F.coalesce(F.substr(record, F.lit(1), F.lit(200)), F.lit("null")))))
    r = r.withColumns({"record_type": kind, "_token": F.col(token)})
    out = r.select(
        *[c for c in rows.columns if c != record],
        "record_type",
        F.when(F.col("record_type") == "data", 0).when(F.col("record_type") == "heartbeat", 1).otherwise(2).alias("record_rank"),
        F.when(F.col("record_type") == "data", data).alias("data"),
        F.when(F.col("record_type") == "heartbeat", beat).alias("heartbeat"),
        F.when(F.col("record_type") == "child", child).alias("child"),
    )
    return _finished(out, token, strict)


def decode_nested(rows: DataFrame, token: str = "partition_token", strict: bool = True) -> DataFrame:
    """Rows of column change_record: an array of structs of three arrays of structs. Records without a time are no records."""
    rest = [c for c in rows.columns if c != "change_record"]
    one = rows.select(*rest, F.explode("change_record").alias("_c"))
    none = {k: F.lit(None).cast(v) for k, v in (("data", DATA), ("heartbeat", HEARTBEAT), ("child", CHILD))}
    parts = []
    for rank, (kind, field, time) in enumerate(
        (("data", "data_change_record", "commit_timestamp"), ("heartbeat", "heartbeat_record", "timestamp"), ("child", "child_partitions_record", "start_timestamp"))
    ):
        part = one.select(*rest, F.explode(F.col(f"_c.{field}")).alias("_x")).where(F.col(f"_x.{time}").isNotNull())
        parts.append(part.select(*rest, F.lit(kind).alias("record_type"), F.lit(rank).alias("record_rank"), *[(F.col("_x") if k == kind else v).alias(k) for k, v in none.items()]))
    return _finished(parts[0].unionByName(parts[1]).unionByName(parts[2]), token, strict)


def _finished(records: DataFrame, token: str, strict: bool) -> DataFrame:
    """Enumerations made safe, mandatory fields asserted, the reading token added to the parents that the root lists."""
    data = F.col("data")
    fixed = data.withField("mod_type", known(data["mod_type"], MOD_TYPES)).withField("value_capture_type", known(data["value_capture_type"], CAPTURE_TYPES))
    if strict:
        missing = F.concat_ws(",", *[F.when(data[f].isNull(), F.lit(f)) for f in MANDATORY])
        fixed = F.when(missing == "", fixed).otherwise(F.raise_error(F.concat(F.lit("data record without "), missing)).cast(records.schema["data"].dataType))
    from_root = lambda c: c.withField(
        "parent_partition_tokens", F.when(F.col(token) == ROOT, F.array_union(F.coalesce(c["parent_partition_tokens"], F.array()), F.array(F.col(token)))).otherwise(c["parent_partition_tokens"])
    )
    child = F.col("child")
    return records.withColumns({
        "data": F.when(data.isNotNull(), fixed),
        "child": F.when(child.isNotNull(), child.withField("child_partitions", F.transform(child["child_partitions"], from_root))),
    })


def named_values(values: Column, columns: Column) -> Column:
    """Positional values (arrays of (column_index, value)) as a map by column name; columns: array of structs with a name."""
    return F.map_from_entries(F.transform(values, lambda v: F.struct(F.get(columns, v["column_index"])["name"], v["value"])))


def decode_positional(rows: DataFrame) -> DataFrame:
    """Mods whose values refer to column_metadata by index (arrays keys, old_values, new_values), as maps like the other formats'."""
    part = lambda m, f: named_values(F.coalesce(m[f], F.array()), F.col("column_metadata")).alias(f)
    return rows.withColumn("mods", F.transform("mods", lambda m: F.struct(part(m, "keys"), part(m, "old_values"), part(m, "new_values"))))


def with_read_metadata(records: DataFrame, read_at: Column, query_started: Column) -> DataFrame:
    """records and _meta: what is known of the reading itself."""
    stamp = F.coalesce(F.col("data.commit_timestamp"), F.col("heartbeat.timestamp"), F.col("child.start_timestamp"))
    return records.withColumn("_meta", F.struct(F.col("partition_token"), stamp.alias("record_timestamp"), query_started.alias("query_started_at"), read_at.alias("record_read_at")))


def children(records: DataFrame, end: str | None = None) -> DataFrame:
    """One row for each child partition that child records list: token, parents (sorted), start, end, origin (the reading token).

    A child ends where the partition does that it was read from; end: the column of records that says when (without: never).
    """
    until = F.col(end) if end else F.lit(None).cast("string")
    c = records.where("record_type = 'child'").select(F.col("partition_token").alias("origin"), F.col("child.start_timestamp").alias("start"), until.alias("end"), F.explode("child.child_partitions").alias("c"))
    return c.select(F.col("c.token").alias("token"), F.sort_array("c.parent_partition_tokens").alias("parents"), "start", "end", "origin")


def partition_records(rows: DataFrame, token: str = "partition_token") -> DataFrame:
    """Records of streams with mutable key ranges: kind (start, event, end), token, time, from_root, moved_from, moved_to.

    rows: structs partition_start (start_timestamp, partition_tokens), partition_event (commit_timestamp, partition_token,
    move_in, move_out) and partition_end (end_timestamp, partition_token), of which one is set. Nothing downstream reads them;
    a start of several tokens gives a row for each.
    """
    s, e, x = F.col("partition_start"), F.col("partition_event"), F.col("partition_end")
    none = F.array().cast("array<string>")
    kind = F.when(s.isNotNull(), "start").when(e.isNotNull(), "event").when(x.isNotNull(), "end")
    tokens = F.when(s.isNotNull(), s["partition_tokens"]).otherwise(F.array(F.coalesce(e["partition_token"], x["partition_token"])))
    return rows.where(kind.isNotNull()).select(
        kind.alias("kind"), F.explode(tokens).alias("token"), F.coalesce(s["start_timestamp"], e["commit_timestamp"], x["end_timestamp"]).alias("time"),
        (s.isNotNull() & (F.col(token) == ROOT)).alias("from_root"), F.coalesce(e["move_in"], none).alias("moved_from"), F.coalesce(e["move_out"], none).alias("moved_to"),
    )
