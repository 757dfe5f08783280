"""The partition lineage: parents and children, which partitions may start, which may be retired, when all is read.

States in order: 0 CREATED, 1 READY, 2 SCHEDULED, 3 RUNNING, 4 FINISHED, 5 REMOVED. edges: token, parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.work import cut

CREATED, READY, SCHEDULED, RUNNING, FINISHED, REMOVED = range(6)
#: A token batch of the root; how long a finished partition stays.
TOKEN_BATCH, RETIRE_AFTER_US = 200, 7_200_000_000


def in_progress(state: Column) -> Column:
    return ~state.isin(FINISHED, REMOVED)


def edges_of(children: DataFrame) -> DataFrame:
    """token, parent for each parent of rows with an array of parents."""
    return children.select("token", F.explode("parents").alias("parent"))


def priority_parent(edges: DataFrame) -> DataFrame:
    """token, priority: the parent (smallest by text) that alone may announce a child of several."""
    return edges.groupBy("token").agg(F.min("parent").alias("priority"), F.count("*").cast("long").alias("parents"))


def accepted_children(announced: DataFrame, edges: DataFrame) -> DataFrame:
    """Announcements (token, origin) that count: of a child of several parents only the priority parent's."""
    p = priority_parent(edges)
    return announced.join(p, "token").where("parents < 2 OR origin = priority").select(*announced.columns)


def new_tokens(found: DataFrame, known: DataFrame) -> DataFrame:
    """Found partitions that nobody knows yet."""
    return found.join(known.select("token"), "token", "left_anti")


def eligible(partitions: DataFrame, edges: DataFrame) -> DataFrame:
    """CREATED partitions that may become READY: all known parents are finished or removed, or no parent is known at all.

    A parent that is unknown while another one is known still has to be seen: such a partition waits.
    """
    states = partitions.groupBy(F.col("token").alias("parent")).agg(F.max("state_ord").alias("_state"))
    p = edges.join(states, "parent", "left").groupBy("token").agg(
        F.count("_state").alias("_known"), F.sum((F.col("_state") >= FINISHED).cast("long")).alias("_done"), F.count("*").alias("_all")
    )
    made = partitions.where(F.col("state_ord") == CREATED).join(p, "token", "left")
    return made.where("_all IS NULL OR _known = 0 OR _done = _all").select(*partitions.columns)


def removable(partitions: DataFrame, edges: DataFrame, now_us: int, after_us: int = RETIRE_AFTER_US) -> DataFrame:
    """FINISHED partitions, long enough ago, all of whose known children are finished or removed."""
    child = partitions.select("token", "state_ord").join(edges, "token")
    live = child.where(in_progress(F.col("state_ord"))).select(F.col("parent").alias("token")).distinct()
    old = partitions.where((F.col("state_ord") == FINISHED) & (F.col("finished_us") + after_us <= now_us))
    return old.join(live, "token", "left_anti")


def already_streaming(ready: DataFrame, all_states: DataFrame) -> DataFrame:
    """READY partitions that no other task has scheduled, runs, or has finished."""
    other = all_states.where(F.col("state_ord") >= SCHEDULED).select("token", F.col("task_uid").alias("_other"))
    return ready.join(other, (ready.token == other.token) & (ready.task_uid != other._other), "left_anti")


def initial_batches(tokens: DataFrame, size: int = TOKEN_BATCH, group: str = "origin") -> DataFrame:
    """tokens and batch: the root's children in batches of so many, by token; numbered within each announcing partition."""
    w = Window.partitionBy(group).orderBy("token")
    return tokens.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def stream_ended(partitions: DataFrame, now_us: int, end_us: int) -> DataFrame:
    """One row: ended, in_progress, finished. Ended: past the end, nothing in progress, something finished."""
    return partitions.agg(
        F.count_distinct(F.when(in_progress(F.col("state_ord")), F.col("token"))).alias("in_progress"),
        F.count_distinct(F.when(F.col("state_ord") == FINISHED, F.col("token"))).alias("finished"),
    ).select(((F.lit(now_us) > end_us) & (F.col("in_progress") == 0) & (F.col("finished") > 0)).alias("ended"), "in_progress", "finished")


def depths(edges: DataFrame) -> DataFrame:
    """token, depth: generations from the oldest known ancestor, the longest way; null on a cycle and behind one; an extension.

    A generation is what has no parent left among the edges that are not yet done, so the edges shrink from join to join; each round is
    checkpointed, and there is one for each generation, however many those are.
    """
    every = edges.select("token").union(edges.select("parent")).distinct()
    left = cut(edges.select("token", "parent").distinct())
    done = level = every.join(left.select("token").distinct(), "token", "left_anti").select("token", F.lit(0).cast("long").alias("depth"))
    d = 0
    while True:
        d += 1
        rest = cut(left.join(level.select(F.col("token").alias("parent")), "parent", "left_anti").select("token", "parent"))
        level = cut(left.select("token").distinct().join(rest.select("token").distinct(), "token", "left_anti").select("token", F.lit(d).cast("long").alias("depth")))
        if not level.limit(1).count():
            return every.join(done, "token", "left")
        done, left = done.union(level), rest
        done = cut(done) if d % 20 == 0 else done  # the plan stays small however long the chain
