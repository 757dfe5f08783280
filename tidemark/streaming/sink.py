"""Writing a stream's envelopes: one folder for each topic, each micro-batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ownership import overloaded
from ..operators.watermark import low_watermark, stamps


def by_key(envelopes: DataFrame, partitions: int, key: str = "key", *order: str) -> DataFrame:
    """envelopes dealt so that all of a key lie in one partition, in order."""
    return envelopes.repartition(partitions, key).sortWithinPartitions(key, *(order or ("ts_us",)))


def write_batch(path: str):
    """A function for foreachBatch: a batch that runs again after a failure replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("poll_us", F.unix_micros(F.current_timestamp())).write.mode("overwrite").partitionBy("topic").parquet(f"{path}/batch={batch_id}")

    return write


def run(envelopes: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start writing envelopes (a stream) under path; once: what is there now, then stop."""
    out = envelopes.writeStream.foreachBatch(write_batch(path)).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def read(spark, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def watermark_batch(claims, offsets, path: str, start_us: int | None = None):
    """A function for foreachBatch that appends the global low watermark as of each batch; claims and offsets are called for tables.

    While a token is claimed twice there is none, and readers keep the last.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        low_watermark(claims(), offsets(), start_us).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def stamp_batch(claims, offsets, tables: DataFrame, output_partitions: int, stream: dict[str, str], path: str, suspended=lambda: False):
    """A function for foreachBatch of a stream that a timer triggers (processingTime, ten seconds by default): each run writes a stamp for
    every table and output partition, with the watermark as of then. While a token is claimed twice, or while suspended, none is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        value = None if suspended() else low_watermark(claims(), offsets()).first()["low_watermark_us"]
        if value is not None:
            stamps(tables, output_partitions, F.lit(value // 1000).cast("long"), stream).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def acknowledged(path: str, spark) -> DataFrame:
    """token, uid, batch of all records whose batch is written whole: what a batch commits is acknowledged. The folder is what write_batch fills
    with envelopes that carry partition_token and record_uid."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*").select(F.col("partition_token").alias("token"), F.col("record_uid").alias("uid"), "batch")


def overload_check(claims, me: str, desired: int):
    """A function for foreachBatch of a stream that a timer triggers (every five seconds by default): a task above its share fails the query, so
    that its partitions are dealt anew."""

    def check(batch: DataFrame, batch_id: int) -> None:
        over = overloaded(claims(), desired).where(F.col("task_uid") == me).first()
        if over is not None:
            raise RuntimeError(f"{me} has {over['load']} partitions, its share is {over['allowed']}")

    return check
