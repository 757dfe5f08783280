"""Handing partitions of tasks that are gone to those that stay.

The greedy form gives all to the leader; equal sharing gives each to whoever has least then. Both are set logic over claims.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.work import cut

from .decode import ROOT
from .lineage import CREATED, FINISHED, READY, REMOVED, RUNNING, SCHEDULED
from .ownership import dealt, first_by_state

COLUMNS = ("task_uid", "kind", "token", "state_ord", "assignee")


def greedy(claims: DataFrame, leader: str, alive: DataFrame) -> DataFrame:
    """The leader's claims after it took what is left of gone tasks: token, kind, state_ord, assignee, step.

    Steps: 0 its own; 1 finished ones of gone tasks; 2 their other owned ones, streaming ones READY again; 3 their shared ones,
    kept shared for a task that stays, else owned; 4 shared ones of the other tasks that stay, addressed to none of them. Each takes only
    tokens that the leader does not know by then.
    """
    own = claims.where(F.col("task_uid") == leader).select("token", "kind", "state_ord", "assignee", F.lit(0).alias("step"))
    gone = claims.join(alive, "task_uid", "left_anti").where(F.col("task_uid") != leader)
    stay = claims.join(alive, "task_uid", "left_semi").where(F.col("task_uid") != leader)
    owned, shared = gone.where("kind = 'owned'"), gone.where("kind = 'shared'")

    def take(have: DataFrame, rows: DataFrame, step: int) -> DataFrame:
        rows = first_by_state(rows).join(have.select("token"), "token", "left_anti")
        return have.unionByName(rows.select("token", "kind", "state_ord", "assignee", F.lit(step).alias("step")))

    none = F.lit(None).cast("string")
    have = take(own, owned.where(F.col("state_ord") == FINISHED), 1)
    again = F.when(F.col("state_ord").isin(SCHEDULED, RUNNING), READY).otherwise(F.col("state_ord")).cast("long")
    have = take(have, owned.where(F.col("state_ord") != FINISHED).withColumn("state_ord", again), 2)
    to = alive.select(F.col("task_uid").alias("assignee"), F.lit(True).alias("_stays"))
    s = shared.join(to, "assignee", "left")
    keep = F.coalesce("_stays", F.lit(False)) & (F.col("assignee") != leader)
    s = s.select("task_uid", "token", "state_ord", F.when(keep, "shared").otherwise("owned").alias("kind"), F.when(keep, F.col("assignee")).otherwise(none).alias("assignee"))
    have = take(have, s, 3)
    others = to.where(F.col("assignee") != leader).select("assignee")
    lost = stay.where("kind = 'shared'").join(others, "assignee", "left_anti")
    return take(have, lost.withColumn("kind", F.lit("owned")).withColumn("assignee", none), 4)


def share_equally(claims: DataFrame, leader: str, alive: list[str]) -> DataFrame:
    """The leader's claims (COLUMNS) after it shared out what gone tasks had; no token is lost and none given twice.

    Finished ones of gone tasks become the leader's. Shared ones stay with a living assignee, as they are; the leader owns those that were
    meant for it. All else that is in progress or shared goes, as CREATED, to whoever has least by then: first what gone tasks shared,
    then what was shared with gone ones, then what gone tasks owned, each by token; of equal tasks the leader, then by text.
    """
    spark = claims.sparkSession
    living = F.broadcast(spark.createDataFrame([(t,) for t in sorted({*alive, leader})], "_task string"))  # as many rows as tasks
    c = claims.select(*COLUMNS)
    stay = c.join(living, c.task_uid == living._task, "left_semi")
    gone = cut(c.join(living, c.task_uid == living._task, "left_anti"))
    meant = lambda t: t.where("kind = 'shared'").join(living, F.col("assignee") == F.col("_task"), "left_semi")
    none = F.lit(None).cast("string")
    mine = stay.where(F.col("task_uid") == leader)
    # 1: finished ones
    owned = stay.where("kind = 'owned'").select("token")
    one = first_by_state(gone.where((F.col("kind") == "owned") & (F.col("state_ord") == FINISHED))).join(owned, "token", "left_anti")
    one = cut(one.select(F.lit(leader).alias("task_uid"), "kind", "token", "state_ord", none.alias("assignee")))
    # 2: shared ones with a living assignee
    known = owned.union(one.select("token")).union(meant(stay).select("token"))
    two = cut(first_by_state(meant(gone)).join(known, "token", "left_anti"))
    own = F.col("assignee") == leader
    kept = two.select(F.lit(leader).alias("task_uid"), F.when(own, "owned").otherwise("shared").alias("kind"), "token", "state_ord", F.when(own, none).otherwise(F.col("assignee")).alias("assignee"))
    # 3: the rest, dealt
    lost = gone.where("kind = 'shared'").select("token", F.lit(0).alias("class"))
    lost = lost.union(stay.where("kind = 'shared'").join(living, F.col("assignee") == F.col("_task"), "left_anti").select("token", F.lit(1)))
    lost = lost.union(gone.where((F.col("kind") == "owned") & ~F.col("state_ord").isin(FINISHED, REMOVED)).select("token", F.lit(2)))
    lost = lost.groupBy("token").agg(F.min("class").alias("class")).join(known.union(two.select("token")), "token", "left_anti")
    held = stay.where((F.col("kind") == "owned") & ~F.col("state_ord").isin(FINISHED, REMOVED)).select("task_uid", "token")
    held = held.union(meant(stay).select("assignee", "token")).union(two.select("assignee", "token")).distinct()
    loads = living.join(held, F.col("_task") == F.col("task_uid"), "left").groupBy("_task").agg(F.count("token").alias("load")).withColumnRenamed("_task", "task_uid")
    given = dealt(cut(lost), loads, leader)
    own = F.col("assignee") == leader
    three = given.select(F.lit(leader).alias("task_uid"), F.when(own, "owned").otherwise("shared").alias("kind"), "token", F.lit(CREATED).cast("long").alias("state_ord"), F.when(own, none).otherwise(F.col("assignee")).alias("assignee"))
    new = cut(one.unionByName(kept).unionByName(three))  # each step is looked at by several others
    have = mine.where("kind = 'owned'").unionByName(new.where("kind = 'owned'"))
    shared = meant(mine).unionByName(new.where("kind = 'shared'")).join(have.select("token"), "token", "left_anti")
    return have.unionByName(shared.select(*COLUMNS))


def leader(assignments: DataFrame) -> DataFrame:
    """generation, consumer_id of the consumers that hold output partition 0 and lead; assignments: generation, consumer_id, partition."""
    return assignments.where("partition = 0").select("generation", "consumer_id")


def cold_start(claims: DataFrame) -> bool:
    """Whether nothing is in progress anywhere: then the root partition is read again."""
    return claims.where(~F.col("state_ord").isin(FINISHED, REMOVED)).limit(1).count() == 0


def new_epoch(claims: DataFrame, leader: str, answered: DataFrame, expected: DataFrame) -> DataFrame:
    """The claims that a leader's new epoch publishes.

    answered: consumer_id, task_uid of the generation; expected: consumer_id. An expected consumer without an answer raises.
    Tasks that did not answer are dropped and what they had is shared out; on a cold start the root joins the leader's.
    """
    absent = expected.join(answered, "consumer_id", "left_anti").limit(5).collect()
    if absent:
        raise ValueError(f"no answer from {', '.join(sorted(r['consumer_id'] for r in absent))}")
    alive = sorted({r["task_uid"] for r in answered.select("task_uid").distinct().collect()} | {leader})
    mine = share_equally(claims, leader, alive)
    others = claims.where(F.col("task_uid").isin(alive) & (F.col("task_uid") != leader)).select(*COLUMNS)
    out = mine.unionByName(others)
    if cold_start(claims):
        out = out.unionByName(claims.sparkSession.createDataFrame([(leader, "owned", ROOT, CREATED, None)], "task_uid string, kind string, token string, state_ord long, assignee string"))
    return out
