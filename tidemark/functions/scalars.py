"""Scalar expressions of change streams: times, resume positions, record ids, latencies, lags, error classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, milliseconds: what may lie between a heartbeat and the watermark, when a record is slow, a heartbeat late.
ACCEPTED_LAG, SLOW, LATE_HEARTBEAT = 60_000, 300_000, 60_000
#: Letters of a record id, and its length.
UID_LETTERS, UID_LENGTH = "abcdefghijklmnopqrstuvwxyz", 8


def order_key(text: Column) -> Column:
    """(sec, nanos) of an RFC 3339 UTC timestamp; Spark's own timestamps lose the nanoseconds."""
    whole = F.split_part(F.split_part(text, F.lit("Z"), F.lit(1)), F.lit("."), F.lit(1))
    fraction = F.split_part(F.split_part(text, F.lit("Z"), F.lit(1)), F.lit("."), F.lit(2))
    return F.struct(
        F.unix_seconds(F.to_timestamp(F.concat(whole, F.lit("Z")))).alias("sec"),
        F.coalesce(F.rpad(fraction, 9, "0").try_cast("int"), F.lit(0)).alias("nanos"),
    )


def epoch_millis(text: Column) -> Column:
    """Milliseconds since 1970 of such a timestamp, rounded down."""
    k = order_key(text)
    return (k["sec"] * 1000 + F.floor(k["nanos"] / 1_000_000)).cast("long")


def epoch_micros(text: Column) -> Column:
    k = order_key(text)
    return (k["sec"] * 1_000_000 + F.floor(k["nanos"] / 1000)).cast("long")


def resume_position(offset: Column, start: Column) -> Column:
    """Where reading goes on: the stored offset, unless there is none or it lies before the start."""
    return F.when(offset.isNull() | (offset < start), start).otherwise(offset)


def record_uid(rank: Column) -> Column:
    """The id of the rank-th record of a partition (0: aaaaaaaa, then the string successor).

    Up to 26**8 - 1 that is base 26. Behind zzzzzzzz successors append: a letter moves from a to z, then another a is appended.
    """
    digit = lambda n, p: F.substr(F.lit(UID_LETTERS), (F.floor(n / 26**p) % 26 + 1).cast("int"), F.lit(1))
    whole = 26**UID_LENGTH
    beyond = rank - whole
    longer = F.concat(F.repeat(F.lit("z"), (UID_LENGTH + F.floor(beyond / 26)).cast("int")), digit(beyond, 0))
    return F.when(rank < whole, F.concat(*[digit(rank, p) for p in reversed(range(UID_LENGTH))])).otherwise(longer)


def successor(text: str) -> str:
    """The next record id: the last letter that is not z moves on, the z's behind it become a; only z's: an a is appended."""
    head = text.rstrip("z")
    if not head:
        return text + "a"
    return head[:-1] + UID_LETTERS[UID_LETTERS.index(head[-1]) + 1] + "a" * (len(text) - len(head))


def latencies(commit: Column, read: Column, emit: Column, poll: Column, publish: Column, watermark: Column, now: Column) -> dict[str, Column]:
    """The latency family in milliseconds, by name; null where a time is missing."""
    return {
        "total_latency": poll - commit,
        "read_to_emit_latency": poll - read,
        "database_latency": read - commit,
        "commit_to_emit_latency": poll - commit,
        "commit_to_publish_latency": publish - commit,
        "emit_to_publish_latency": publish - poll,
        "own_latency": emit - read,
        "low_watermark_lag": now - watermark,
        "behind_low_watermark": now - watermark,
    }


def stuck_intervals(last: Column, now: Column, heartbeat: Column) -> Column:
    """Whole heartbeat intervals since the last event."""
    return F.floor((now - last) / heartbeat).cast("long")


def is_stuck(last: Column, now: Column, heartbeat: Column, max_missed: int = 10) -> Column:
    return last < now - heartbeat * max_missed


def lags_too_much(offset: Column, now: Column, heartbeat: Column) -> Column:
    """Whether an offset is older than a heartbeat and ACCEPTED_LAG."""
    return now - offset > heartbeat + ACCEPTED_LAG


def offset_lag(start_us: Column, now_ms: Column) -> Column:
    """Milliseconds by which a partition's position lies behind now."""
    return now_ms - F.floor(start_us / 1000).cast("long")


def task_uid(connector: Column, task: Column, unique: Column) -> Column:
    return F.concat(connector, F.lit("_task-"), task.cast("string"), F.lit("_"), unique)


def error_class(code: Column) -> Column:
    """fatal for positions out of range and for what is no database error (null), else retriable."""
    return F.when(code.isNull() | (code == "OUT_OF_RANGE"), "fatal").otherwise("retriable")


def pretty(value: Column) -> Column:
    return F.to_json(value, {"pretty": "true"})
