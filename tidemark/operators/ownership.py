"""Who owns what: partition counts, load, the least loaded task, duplicates, shared partitions.

claims: task_uid, kind (owned or shared), token, state_ord, assignee (of shared ones), ...
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import FINISHED, in_progress


def first_by_state(claims: DataFrame, *keys: str) -> DataFrame:
    """One row for each token, the least advanced state's; of equal states the smallest task's."""
    w = Window.partitionBy("token").orderBy("state_ord", "task_uid", *keys)
    return claims.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def duplicated(claims: DataFrame) -> DataFrame:
    """token, claims of tokens that more than one row in progress claims."""
    return claims.where(in_progress(F.col("state_ord"))).groupBy("token").agg(F.count("*").alias("claims")).where("claims > 1")


def shared_not_owned(claims: DataFrame) -> DataFrame:
    """Shared rows whose token no task owns."""
    owned = claims.where("kind = 'owned'").select("token")
    return claims.where("kind = 'shared'").join(owned, "token", "left_anti")


def partition_counts(claims: DataFrame) -> DataFrame:
    """One row: owned (distinct, in progress) and shared_only (distinct, owned by nobody)."""
    owned = claims.where("kind = 'owned'").where(in_progress(F.col("state_ord"))).agg(F.count_distinct("token").alias("owned"))
    return owned.crossJoin(shared_not_owned(claims).agg(F.count_distinct("token").alias("shared_only")))  # a row by a row


def token_totals(claims: DataFrame) -> DataFrame:
    """One row: distinct tokens in progress, finished, all."""
    of = lambda c: F.count_distinct(F.when(c, F.col("token")))
    state = F.col("state_ord")
    return claims.agg(of(in_progress(state)).alias("in_progress"), of(state == FINISHED).alias("finished"), F.count_distinct("token").alias("all_tokens"))


def load(claims: DataFrame) -> DataFrame:
    """task_uid, load: distinct tokens that a task owns in progress or is to take over. Tasks without any have 0."""
    owned = claims.where("kind = 'owned'").where(in_progress(F.col("state_ord"))).select("task_uid", "token")
    coming = claims.where("kind = 'shared' AND assignee IS NOT NULL").select(F.col("assignee").alias("task_uid"), "token")
    counted = owned.union(coming).groupBy("task_uid").agg(F.count_distinct("token").alias("load"))
    return claims.select("task_uid").distinct().join(counted, "task_uid", "left").select("task_uid", F.coalesce("load", F.lit(0)).cast("long").alias("load"))


def least_loaded(loads: DataFrame, me: str | None = None) -> DataFrame:
    """One row: the task of least load; of equal ones the asking task, else the smallest by text."""
    order = F.struct("load", (F.col("task_uid") != F.lit(me)).alias("other") if me else F.lit(True).alias("other"), "task_uid")
    return loads.agg(F.min_by("task_uid", order).alias("task_uid"), F.min("load").alias("load"))


def dealt(tokens: DataFrame, loads: DataFrame, me: str) -> DataFrame:
    """token, assignee: tokens (token, class), in the order of class and token, each given to whoever has least by then; of equal ones to me,
    then by text. loads: task_uid, load, small.

    Giving to the least loaded again and again fills the places (level, task) from the lowest level up: the n-th token gets the n-th
    place. Tokens are a stream's partitions, so one task may number them.
    """
    spark = tokens.sparkSession
    many = tokens.count()
    have = sorted((r["load"], r["task_uid"] != me, r["task_uid"]) for r in loads.collect())
    low, top = 0, max((n for n, _, _ in have), default=0) + many  # the least level below which there are places enough
    while low < top:
        middle = (low + top) // 2
        low, top = (low, middle) if sum(max(0, middle - n) for n, _, _ in have) >= many else (middle + 1, top)
    places = spark.createDataFrame([(n, o, t) for n, o, t in have], "load long, other boolean, task_uid string").where(F.col("load") < top)
    places = places.select(F.explode(F.sequence("load", F.lit(top - 1).cast("long"))).alias("level"), "other", "task_uid")
    places = places.select(F.row_number().over(Window.orderBy("level", "other", "task_uid")).alias("_n"), F.col("task_uid").alias("assignee"))
    return tokens.select("token", F.row_number().over(Window.orderBy("class", "token")).alias("_n")).join(places, "_n").select("token", "assignee")


def to_take(claims: DataFrame, me: str) -> DataFrame:
    """Shared rows addressed to a task, one for each token."""
    return first_by_state(claims.where((F.col("kind") == "shared") & (F.col("assignee") == me)))


def still_shared(claims: DataFrame) -> DataFrame:
    """Claims without the shared ones whose token is owned by now."""
    owned = claims.where("kind = 'owned'").select("token").distinct().withColumn("_o", F.lit(True))
    return claims.join(owned, "token", "left").where("kind = 'owned' OR _o IS NULL").select(*claims.columns)


def overloaded(claims: DataFrame, desired: int) -> DataFrame:
    """task_uid, load, allowed: tasks above both the desired load and twice the even share (whole division) of all tokens in
    progress."""
    state = F.col("state_ord")
    share = claims.agg(F.count_distinct(F.when(in_progress(state), F.col("token"))).alias("total"), F.count_distinct("task_uid").alias("tasks"))
    both = load(claims).join(F.broadcast(share), F.lit(True))  # one row
    both = both.withColumn("allowed", F.expr("(total div tasks) * 2"))
    return both.where((F.col("load") > desired) & (F.col("load") > F.col("allowed"))).select("task_uid", "load", "allowed")


def survivors(claims: DataFrame, alive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claims of tasks that are alive, claims of those that are not)."""
    return claims.join(alive, "task_uid", "left_semi"), claims.join(alive, "task_uid", "left_anti")


def all_tokens(claims: DataFrame) -> DataFrame:
    return claims.select("token").distinct()
