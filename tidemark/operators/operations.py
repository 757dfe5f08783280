"""What a task does with partitions, step by step: register children, schedule, retire."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import CREATED, READY, REMOVED, RETIRE_AFTER_US, SCHEDULED, accepted_children, already_streaming, new_tokens, removable
from .ownership import dealt, load


def children_registered(claims: DataFrame, announced: DataFrame, edges: DataFrame, me: str) -> DataFrame:
    """token, origin, assignee, kind, state_ord: what a task makes of announced children (token, origin).

    Of a child of several parents only the priority parent's announcement counts, what any task knows already is skipped, and
    the rest goes, by token, each to whoever has least by then (of equal ones to the asking task, then by text): its own ones it
    owns, others it shares. All are CREATED.
    """
    new = new_tokens(accepted_children(announced, edges), claims).groupBy("token").agg(F.min("origin").alias("origin"))
    given = dealt(new.select("token", F.lit(0).alias("class")), load(claims), me)
    kind = F.when(F.col("assignee") == me, "owned").otherwise("shared")
    return new.join(given, "token").select("token", "origin", "assignee", kind.alias("kind"), F.lit(CREATED).cast("long").alias("state_ord"))


def scheduled(claims: DataFrame, me: str, room: int) -> DataFrame:
    """token, state_ord of a task's own READY partitions that no other task streams: SCHEDULED for the first by token that the pool has room
    for, READY for the others."""
    ready = already_streaming(claims.where((F.col("task_uid") == me) & (F.col("kind") == "owned") & (F.col("state_ord") == READY)), claims)
    place = F.row_number().over(Window.orderBy("token"))  # a task's own partitions
    return ready.select("token", F.when(place <= room, SCHEDULED).otherwise(READY).cast("long").alias("state_ord"))


def retired(partitions: DataFrame, edges: DataFrame, now_us: int, after_us: int = RETIRE_AFTER_US) -> DataFrame:
    """token, state_ord, offset_us of partitions that may be retired: REMOVED, and an empty position that clears the stored one."""
    gone = removable(partitions, edges, now_us, after_us)
    return gone.select("token", F.lit(REMOVED).cast("long").alias("state_ord"), F.lit(None).cast("long").alias("offset_us")).distinct()
