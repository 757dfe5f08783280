"""The global low watermark: the least position of any partition in work. It is no event-time watermark and drops nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decode import ROOT
from .envelope import stamp_source
from .lineage import in_progress


def _live(claims: DataFrame) -> DataFrame:
    """Owned rows in progress, and all shared ones that nobody owns."""
    owned = claims.where("kind = 'owned'")
    shared = claims.where("kind = 'shared'").join(owned.select("token"), "token", "left_anti")
    return owned.where(in_progress(F.col("state_ord"))).unionByName(shared)


def low_watermark(claims: DataFrame, offsets: DataFrame, start_us: int | None = None) -> DataFrame:
    """One row: low_watermark_us, partitions, duplicates.

    The least of coalesce(offset, start) over live partitions; while the root is live, its start; null while a token is claimed
    twice; the configured start where nothing is live.
    """
    live = _live(claims)
    twice = live.groupBy("token").count().where("count > 1").agg(F.count("*").alias("duplicates"))
    w = live.join(offsets, "token", "left").agg(
        F.min(F.coalesce("offset_us", "start_us")).alias("_least"), F.min(F.when(F.col("token") == ROOT, F.col("start_us"))).alias("_root"), F.count_distinct("token").alias("partitions")
    )
    both = w.crossJoin(twice)  # a row by a row
    value = F.coalesce("_root", "_least", F.lit(start_us).cast("long"))
    return both.select(F.when(F.col("duplicates") == 0, value).alias("low_watermark_us"), "partitions", "duplicates")


def monotone(watermarks: DataFrame, by: str, order: str, value: str = "low_watermark_us") -> DataFrame:
    """watermarks and monotone: the running maximum of each group, as offsets that are not found make the raw one fall back."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return watermarks.withColumn("monotone", F.max(value).over(w))


def stamps(tables: DataFrame, output_partitions: int, watermark_ms: Column, stream: dict[str, str], prefix: str = "cdc") -> DataFrame:
    """An m record for each table and output partition: topic, output_partition, op, source. tables: table_name, as many as are captured."""
    each = tables.withColumn("output_partition", F.explode(F.sequence(F.lit(0), F.lit(output_partitions - 1))))
    return each.select(
        F.concat_ws(".", F.lit(prefix), "table_name").alias("topic"), F.col("output_partition").cast("long").alias("output_partition"), F.lit("m").alias("op"),
        stamp_source(stream, F.col("table_name"), watermark_ms).alias("source"),
    )


def stamp_times(start_us: int, end_us: int, period_ms: int = 10_000) -> list[int]:
    """When a publisher that began at start stamps, to end (microseconds): every period, not before the first is over."""
    return list(range(start_us + period_ms * 1000, end_us + 1, period_ms * 1000))
