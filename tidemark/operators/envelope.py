"""From data records to output records: exploded mods, typed images, provenance, headers, tombstones, topics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import epoch_micros, epoch_millis, order_key, record_uid
from ..functions.types import ColumnType, coerce


def table_filter(name: Column, include: str | None = None, exclude: str | None = None) -> Column:
    """Comma-separated regular expressions over whole names, whatever their case; exclude counts only without include."""
    any_of = lambda text: "(?i)^(?:" + "|".join(f"(?:{p.strip()})" for p in re.split(r"(?<!\\),", text) if p.strip()) + ")$"
    if include and include.strip():
        return name.rlike(any_of(include))
    return ~name.rlike(any_of(exclude)) if exclude and exclude.strip() else F.lit(True)


def explode_mods(records: DataFrame, first: int = 0, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """One row for each mod of the data records of the chosen tables, in order; mod_number counts from first.

    The table filter stands below the explode, so that unwanted records are never multiplied.
    """
    wanted = records.where("record_type = 'data'").where(table_filter(F.col("data.table_name"), include, exclude))
    rest = [c for c in records.columns if c not in ("record_type", "record_rank", "heartbeat", "child", "data")]
    d = wanted.select(*rest, F.explode(F.array("data")).alias("data")).select(*rest, "data", F.posexplode("data.mods").alias("_pos", "mod"))
    return d.select(*rest, F.col("data").dropFields("mods").alias("data"), (F.col("_pos") + first).alias("mod_number"), "mod")


def operation(mod_type: Column) -> Column:
    """c, u or d; any other mod type raises."""
    return F.when(mod_type == "INSERT", "c").when(mod_type == "UPDATE", "u").when(mod_type == "DELETE", "d").otherwise(
        F.raise_error(F.concat(F.lit("no operation for mod type "), F.coalesce(mod_type, F.lit("null"))))
    )


def image(mod: Column, part: str, columns: dict[str, ColumnType], lenient: bool = True) -> Column:
    """A typed struct of the columns, keys first and then part (new_values or old_values); a missing value is null."""
    value = lambda c: F.when(F.map_contains_key(mod["keys"], c), mod["keys"][c]).otherwise(mod[part][c])
    return F.struct(*[coerce(value(c), t, lenient).alias(c) for c, t in columns.items()])


def watched(columns: dict[str, ColumnType], keys: list[str], chosen: list[str] | None) -> dict[str, ColumnType]:
    """The columns a stream shows: keys, and those it watches (None: all)."""
    return {c: t for c, t in columns.items() if chosen is None or c in keys or c in chosen}


def source_info(stream: dict[str, str], low_watermark: Column | None = None) -> Column:
    """The provenance struct of exploded mods; stream: project_id, instance_id, database_id, change_stream_name, all needed."""
    for name in ("project_id", "instance_id", "database_id", "change_stream_name"):
        if not stream.get(name):
            raise ValueError(f"{name} is needed")
    d = F.col("data")
    return F.struct(
        *[F.lit(stream[n]).alias(n) for n in ("project_id", "instance_id", "database_id", "change_stream_name")],
        d["table_name"].alias("table"),
        d["server_transaction_id"].alias("server_transaction_id"),
        (low_watermark if low_watermark is not None else F.lit(None).cast("long")).alias("low_watermark"),
        epoch_millis(d["commit_timestamp"]).alias("ts_ms"),
        d["record_sequence"].cast("long").alias("record_sequence"),
        d["number_of_records_in_transaction"].alias("number_records_in_transaction"),
        d["transaction_tag"].alias("transaction_tag"),
        d["is_system_transaction"].alias("system_transaction"),
        d["value_capture_type"].alias("value_capture_type"),
        F.col("partition_token").alias("partition_token"),
        F.col("mod_number").cast("int").alias("mod_number"),
        d["is_last_record_in_transaction_in_partition"].alias("is_last_record_in_transaction_in_partition"),
        d["number_of_partitions_in_transaction"].alias("number_of_partitions_in_transaction"),
    )


def stamp_source(stream: dict[str, str], table: Column, low_watermark: Column) -> Column:
    """The provenance struct of a watermark stamp: names, table and watermark; all else is null."""
    for name in ("project_id", "instance_id", "database_id", "change_stream_name"):
        if not stream.get(name):
            raise ValueError(f"{name} is needed")
    kinds = {"server_transaction_id": "string", "ts_ms": "long", "record_sequence": "long", "number_records_in_transaction": "long", "transaction_tag": "string", "system_transaction": "boolean",
             "value_capture_type": "string", "partition_token": "string", "mod_number": "int", "is_last_record_in_transaction_in_partition": "boolean", "number_of_partitions_in_transaction": "long"}
    none = {n: F.lit(None).cast(t).alias(n) for n, t in kinds.items()}
    names = [F.lit(stream[n]).alias(n) for n in ("project_id", "instance_id", "database_id", "change_stream_name")]
    return F.struct(*names, table.alias("table"), none.pop("server_transaction_id"), low_watermark.alias("low_watermark"), *none.values())


def with_record_uid(mods: DataFrame, slot_seconds: int = 3600) -> DataFrame:
    """mods and record_uid: each partition's records in commit order, numbered in letters.

    Records are numbered within slots of time, and each slot begins where the ones before it end, so that no task sorts a partition's
    whole history.
    """
    k = order_key(F.col("data.commit_timestamp"))
    m = mods.withColumns({"_k": k, "_slot": F.floor(k["sec"] / slot_seconds)})
    order = ["_k.sec", "_k.nanos", "data.record_sequence", "data.server_transaction_id", "mod_number"]
    inner = F.row_number().over(Window.partitionBy("partition_token", "_slot").orderBy(*order)).cast("long")
    sizes = m.groupBy(F.col("partition_token").alias("_token"), F.col("_slot").alias("_of")).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("_token").orderBy("_of")) - F.col("_size")
    starts = sizes.select("_token", "_of", before.alias("_before"))
    out = m.withColumn("_n", inner).join(starts, F.col("partition_token").eqNullSafe(F.col("_token")) & F.col("_slot").eqNullSafe(F.col("_of")))
    return out.select(*mods.columns, record_uid(F.col("_before") + F.col("_n") - 1).alias("record_uid"))


def envelope(
    mods: DataFrame, columns: dict[str, ColumnType], keys: list[str], stream: dict[str, str], prefix: str = "cdc", low_watermark: Column | None = None, lenient: bool = True
) -> DataFrame:
    """topic, key, op, before, after, source, ts_ms, offset, and the other columns of mods.

    Creates have no before, deletes no after. key is null where keys is empty.
    """
    op = operation(F.col("data.mod_type"))
    rest = [c for c in mods.columns if c not in ("data", "mod", "mod_number")]
    key = F.struct(*[coerce(F.col("mod.keys")[c], columns[c], lenient).alias(c) for c in keys]) if keys else F.lit(None).cast("struct<>")
    e = mods.withColumn("op", op)
    return e.select(
        F.concat_ws(".", F.lit(prefix), F.col("data.table_name")).alias("topic"),
        key.alias("key"),
        "op",
        F.when(F.col("op") != "c", image(F.col("mod"), "old_values", columns, lenient)).alias("before"),
        F.when(F.col("op") != "d", image(F.col("mod"), "new_values", columns, lenient)).alias("after"),
        source_info(stream, low_watermark).alias("source"),
        epoch_millis(F.col("data.commit_timestamp")).alias("ts_ms"),
        epoch_micros(F.col("data.commit_timestamp")).alias("ts_us"),
        offset_map(F.col("data.commit_timestamp")).alias("offset"),
        *rest,
    )


def offset_map(position: Column, start: Column | None = None, query_started: Column | None = None) -> Column:
    """A partition's stored position as a map of strings."""
    none = F.lit(None).cast("string")
    return F.create_map(F.lit("offset"), position, F.lit("startTime"), start if start is not None else none, F.lit("queryStartedAt"), query_started if query_started is not None else none)


def headers(record_uid_: Column, emitted: Column, polled: Column | None = None, published: Column | None = None) -> Column:
    """Record headers as a map of strings; what is not known yet is left out."""
    pairs = [("recordUid", record_uid_), ("emitTimestamp", emitted), ("pollTimestamp", polled), ("publishTimestamp", published)]
    return F.map_filter(F.create_map(*[x for n, c in pairs if c is not None for x in (F.lit(n), c.cast("string"))]), lambda _, v: v.isNotNull())


def is_data_change(headers_: Column) -> Column:
    return headers_["recordUid"].isNotNull()


def with_tombstones(envelopes: DataFrame) -> DataFrame:
    """envelopes and tombstone: behind each delete a row of the same key whose op, before, after and source are null."""
    copies = F.when(F.col("op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    e = envelopes.withColumn("tombstone", F.explode(copies))
    return e.withColumns({c: F.when(~F.col("tombstone"), F.col(c)) for c in ("op", "before", "after", "source") if c in envelopes.columns})


def heartbeats(records: DataFrame) -> DataFrame:
    """Heartbeat records for their own topic: key (the token) and value (ts_ms), always to output partition 0."""
    h = records.where("record_type = 'heartbeat'")
    return h.select(F.struct("partition_token").alias("key"), F.struct(epoch_millis(F.col("heartbeat.timestamp")).alias("ts_ms")).alias("value"), F.lit(0).alias("output_partition"))


def summary(op: Column, position: Column, key: Column, before: Column, after: Column) -> Column:
    """A record as one line; parts that are null are left out."""
    part = lambda n, c: F.when(c.isNotNull(), F.concat(F.lit(f"{n}: "), c if n == "operation" else F.to_json(c)))
    return F.concat_ws(", ", part("operation", op), part("position", position), part("key", key), part("before", before), part("after", after))


def event_metadata(source: Column, value: Column) -> Column:
    """(timestamp, position, transaction) of a record; null where value or source is."""
    position = F.create_map(
        F.lit("record_sequence"), source["record_sequence"].cast("string"), F.lit("change_stream_name"), source["change_stream_name"], F.lit("table"), source["table"]
    )
    return F.when(value.isNotNull() & source.isNotNull(), F.struct(source["ts_ms"].alias("timestamp"), position.alias("position"), source["server_transaction_id"].alias("transaction_id")))


def deduplicated(mods: DataFrame) -> DataFrame:
    """Mods delivered again after a restart are dropped: one row for each (token, transaction, sequence, mod)."""
    keyed = mods.withColumns({"_t": F.col("data.server_transaction_id"), "_s": F.col("data.record_sequence")})
    return keyed.dropDuplicates(["partition_token", "_t", "_s", "mod_number"]).drop("_t", "_s")
