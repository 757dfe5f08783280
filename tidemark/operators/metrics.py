"""Measurements: latency statistics and quantiles, slow records, stuck partitions, counters, the number of tasks to run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import LATE_HEARTBEAT, SLOW, is_stuck, latencies, stuck_intervals

QUANTILES = (0.5, 0.95, 0.99)


def latency_table(records: DataFrame, watermark_ms: Column, now_ms: Column) -> DataFrame:
    """records' event_id and every latency; records: commit_ms, read_ms, emit_ms, poll_ms, publish_ms."""
    c = {n: F.col(f"{n}_ms") for n in ("commit", "read", "emit", "poll", "publish")}
    found = latencies(c["commit"], c["read"], c["emit"], c["poll"], c["publish"], watermark_ms, now_ms)
    return records.select("event_id", *[v.alias(k) for k, v in found.items()])


def statistics(rows: DataFrame, value: str, order: str, *by: str) -> DataFrame:
    """Least, most, mean, last and number of values, by group; nulls are left out."""
    v = F.col(value)
    return rows.where(v.isNotNull()).groupBy(*by).agg(
        F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("avg_value"), F.max_by(v, order).alias("last_value"), F.count("*").alias("values")
    )


def quantiles(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """p50, p95, p99 by group, exact."""
    out = rows.groupBy(*by).agg(F.percentile(value, list(QUANTILES)).alias("_q"))
    return out.select(*by, *[F.col("_q")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(QUANTILES)])


def sketch(rows: DataFrame, value: str, *by: str, accuracy: float = 0.01) -> DataFrame:
    """The groups' values in buckets whose bounds grow by a constant factor: by, bucket (null for 0 and less), n. Sketches of parts add up."""
    growth = math.log((1 + accuracy) / (1 - accuracy))
    return rows.where(F.col(value).isNotNull()).groupBy(*by, F.when(F.col(value) > 0, F.ceil(F.ln(F.col(value)) / growth)).alias("bucket")).agg(F.count("*").alias("n"))


def quantiles_of(buckets: DataFrame, *by: str, accuracy: float = 0.01) -> DataFrame:
    """p50, p95, p99 of sketches, each within `accuracy` of the value of that rank, relative to it. There are few buckets a group."""
    growth = math.log((1 + accuracy) / (1 - accuracy))
    middle = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.exp(F.col("bucket") * growth) / (1 + math.exp(growth)))
    w = Window.partitionBy(*by)
    upto = buckets.withColumns({"_upto": F.sum("n").over(w.orderBy(F.col("bucket").asc_nulls_first())), "_all": F.sum("n").over(w), "_v": middle})
    rank = lambda q: F.floor(F.lit(q) * (F.col("_all") - 1))
    return upto.groupBy(*by).agg(*[F.min(F.when(F.col("_upto") > rank(q), F.col("_v"))).alias(f"p{int(q * 100)}") for q in QUANTILES])


def quantiles_by_interval(rows: DataFrame, value: str, time: str, interval: int, *by: str, accuracy: float = 0.01) -> DataFrame:
    """The same for each interval of time (in time's unit), after which the meter begins anew: by, interval, p50, p95, p99."""
    r = rows.withColumn("interval", F.floor(F.col(time) / interval).cast("long"))
    return quantiles_of(sketch(r, value, *by, "interval", accuracy=accuracy), *by, "interval", accuracy=accuracy)


def slow(rows: DataFrame, *values: str, limit: int = SLOW) -> DataFrame:
    """Rows of which one of the values exceeds the limit."""
    any_ = F.lit(False)
    for v in values:
        any_ = any_ | F.coalesce(F.col(v) > limit, F.lit(False))
    return rows.where(any_)


def stuck(partitions: DataFrame, last: str, now: Column, heartbeat: int, max_missed: int = 10) -> DataFrame:
    """partitions, intervals without an event, and whether they are stuck; the root, which only lists others, is left out."""
    p = partitions.where("token <> 'Parent0'")
    return p.withColumns({"intervals": stuck_intervals(F.col(last), now, F.lit(heartbeat).cast("long")), "is_stuck": is_stuck(F.col(last), now, F.lit(heartbeat).cast("long"), max_missed)})


def late_heartbeats(heartbeats: DataFrame, now_ms: Column, limit: int = LATE_HEARTBEAT) -> DataFrame:
    """Heartbeats (at_ms) that lie further back than the limit."""
    return heartbeats.where(now_ms - F.col("at_ms") > limit)


def task_activity(claims: DataFrame) -> DataFrame:
    """One row: distinct partitions in work, tasks, and tasks that own none in progress."""
    work = F.when(~F.col("state_ord").isin(4, 5), F.col("token"))
    tasks = claims.groupBy("task_uid").agg(F.bool_or((F.col("kind") == "owned") & ~F.col("state_ord").isin(4, 5)).alias("busy"))
    return claims.agg(F.count_distinct(work).alias("in_work")).crossJoin(tasks.agg(F.count("*").alias("tasks"), F.count_if(~F.col("busy")).alias("idle")))  # a row by a row


def scale(current: int, desired: int, least: int, most: int, in_work: int, idle: int) -> int:
    """How many tasks to run. A fifth more, rounded up, as long as each task has more than desired partitions and the most is not
    reached; then, where each has less than desired and more than half are idle, half of them, rounded down. Never below least."""
    tasks = min(max(current, least), most)
    while tasks < most and tasks and in_work / tasks > desired:
        tasks = min(most, tasks + math.ceil(0.2 * tasks))
    if tasks > least and in_work < desired * tasks and 2 * idle > tasks:
        tasks = max(least, tasks // 2)
    return tasks


def autoscale(messages: DataFrame, desired: int, least: int, most: int) -> DataFrame:
    """log_offset, required: how many tasks each message asks for; messages: log_offset, message_type, tasks, in_work, idle.

    The first message counts from the least number of tasks; after it only UPDATE_EPOCH messages count, each from the tasks it lists. Each
    decision depends on its own message alone, so this is scale() as an expression over all of them at once.
    """
    first = messages.agg(F.min("log_offset").alias("_first"))
    m = messages.join(F.broadcast(first), F.lit(True)).where((F.col("log_offset") == F.col("_first")) | (F.col("message_type") == "UPDATE_EPOCH"))  # one row
    return m.select("log_offset", scaled(F.when(F.col("log_offset") == F.col("_first"), F.lit(least)).otherwise(F.col("tasks")), desired, least, most, F.col("in_work"), F.col("idle")).alias("required"))


def scaled(current: Column, desired: int, least: int, most: int, in_work: Column, idle: Column) -> Column:
    """scale() as a column."""
    start = F.least(F.greatest(current, F.lit(least)), F.lit(most)).cast("int")
    more = lambda t, _: F.when((t < most) & (t > 0) & (in_work > t * desired), F.least(F.lit(most), t + F.ceil(t * F.lit(2) / 10).cast("int"))).otherwise(t)
    up = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, most))), start, more)
    return F.transform(F.array(up), lambda t: F.when((t > least) & (in_work < desired * t) & (2 * idle > t), F.greatest(F.lit(least), F.floor(t / 2).cast("int"))).otherwise(t))[0]


def counters(events: DataFrame) -> DataFrame:
    """Sums, counts, last values and distinct names of metric events (name, kind, value, text, at), by name."""
    return events.groupBy("name").agg(
        F.sum(F.when(F.col("kind") == "sum", F.col("value"))).alias("total"),
        F.count(F.when(F.col("kind") == "count", 1)).alias("times"),
        F.max_by("value", "at").alias("last"),
        F.sort_array(F.collect_set("text")).alias("names"),
    )
