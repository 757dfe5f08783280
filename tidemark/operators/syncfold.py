"""Folding the log by which tasks tell each other their states.

Messages: log_offset, task_uid, consumer_id, message_type (REGULAR, REBALANCE_ANSWER, UPDATE_EPOCH, NEW_EPOCH), generation,
state_ts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCHS = ("NEW_EPOCH", "UPDATE_EPOCH")


def from_offset(log: DataFrame, epoch_offset: int) -> DataFrame:
    """The log from where the last epoch begins."""
    return log.where(F.col("log_offset") >= epoch_offset)


def fresh(log: DataFrame, current: int, last_received: int) -> DataFrame:
    """Messages that are not of an older generation: epochs before the current one, answers also before the last received; regular ones always count."""
    g, t = F.col("generation"), F.col("message_type")
    stale = (t.isin(*EPOCHS) & (g < current)) | ((t == "REBALANCE_ANSWER") & ((g < current) | (g < last_received)))
    return log.where(~stale)


def current_rebalances(events: DataFrame, generation: int, last_received: int) -> DataFrame:
    """Rebalance events (generation, ...) that are not stale: of the current generation and the last received one, or later."""
    return events.where((F.col("generation") >= generation) & (F.col("generation") >= last_received))


def epoch_offsets(log: DataFrame, every_us: int, time: str) -> DataFrame:
    """slot, epoch_offset: what a leader publishes every so often as the place where the next reader begins, the latest epoch message by
    then."""
    epochs = log.where(F.col("message_type").isin(*EPOCHS))
    return epochs.groupBy(F.floor(F.col(time) / every_us).cast("long").alias("slot")).agg(F.max("log_offset").alias("epoch_offset"))


WIRE = "task_uid string, consumer_id string, message_type string, generation long, state_ts long"


def to_wire(messages: DataFrame) -> DataFrame:
    """log_offset, key (the task), value (the message as JSON text)."""
    names = [f.split()[0] for f in WIRE.split(", ")]
    return messages.select("log_offset", F.col("task_uid").alias("key"), F.to_json(F.struct(*names)).alias("value"))


def from_wire(log: DataFrame) -> DataFrame:
    """Messages from what to_wire made; text that is no message raises."""
    m = log.select("log_offset", F.from_json("value", WIRE, {"mode": "FAILFAST"}).alias("_m"))
    return m.select("log_offset", "_m.*")


def publish(messages: DataFrame, path: str) -> None:
    """Append messages to the log at path, a task's in one file each."""
    to_wire(messages).repartition("key").sortWithinPartitions("log_offset").write.mode("append").parquet(path)


def initialised(log: DataFrame, upto: int) -> bool:
    """Whether a reader that has seen the log to `upto` may begin: an epoch has been announced by then."""
    return log.where(F.col("message_type").isin(*EPOCHS) & (F.col("log_offset") <= upto)).limit(1).count() > 0


def latest_states(log: DataFrame) -> DataFrame:
    """Each task's newest message: the latest state_ts; of equal ones the earlier in the log stays."""
    newest = F.struct("state_ts", (-F.col("log_offset")).alias("_o"))
    rest = [c for c in log.columns if c != "task_uid"]
    got = log.groupBy("task_uid").agg(F.max_by(F.struct(*rest), newest).alias("_x"))
    return got.select("task_uid", *[F.col(f"_x.{c}").alias(c) for c in rest])


def merged(states: DataFrame, messages: DataFrame) -> DataFrame:
    """States after the messages: epochs and answers may bring new tasks, regular messages only renew known ones."""
    known = states.select("task_uid").union(messages.where("message_type <> 'REGULAR'").select("task_uid")).distinct()
    use = messages.where("message_type <> 'REGULAR'").unionByName(messages.where("message_type = 'REGULAR'").join(known, "task_uid", "left_semi"))
    old = states.withColumn("_old", F.lit(1))
    both = old.unionByName(use.withColumn("_old", F.lit(0)))
    newest = F.struct("state_ts", "_old", (-F.col("log_offset")).alias("_o"))  # only a strictly newer one replaces
    rest = [c for c in states.columns if c != "task_uid"]
    got = both.groupBy("task_uid").agg(F.max_by(F.struct(*rest), newest).alias("_x"))
    return got.select("task_uid", *[F.col(f"_x.{c}").alias(c) for c in rest])


def epoch_update(states: DataFrame, message_states: DataFrame, me: str) -> DataFrame:
    """Others' states after an UPDATE_EPOCH: of tasks that the message lists only, the newer of both; of equal times ours."""
    ours = states.join(message_states.select("task_uid"), "task_uid", "left_semi").withColumn("_old", F.lit(1))
    both = ours.unionByName(message_states.where(F.col("task_uid") != me).withColumn("_old", F.lit(0)))
    rest = [c for c in states.columns if c != "task_uid"]
    got = both.groupBy("task_uid").agg(F.max_by(F.struct(*rest), F.struct("state_ts", "_old")).alias("_x"))
    return got.select("task_uid", *[F.col(f"_x.{c}").alias(c) for c in rest])


def new_epoch_states(message_states: DataFrame, me: str) -> DataFrame:
    """Others' states after a NEW_EPOCH: the message's, whatever was known before."""
    return message_states.where(F.col("task_uid") != me)


def missing_consumers(expected: DataFrame, log: DataFrame, generation: int) -> DataFrame:
    """Expected consumers from which no answer of the generation came."""
    answered = log.where((F.col("message_type") == "REBALANCE_ANSWER") & (F.col("generation") == generation)).select("consumer_id")
    return expected.join(answered, "consumer_id", "left_anti")


def matched(expected: DataFrame, log: DataFrame, generation: int) -> DataFrame:
    """consumer_id, task_uid of the consumers that answered a generation."""
    answers = log.where((F.col("message_type") == "REBALANCE_ANSWER") & (F.col("generation") == generation))
    return expected.join(answers.select("consumer_id", "task_uid").distinct(), "consumer_id")


def split_epoch(states: DataFrame, alive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(states of tasks that survive an epoch, states of those that do not)."""
    return states.join(alive, "task_uid", "left_semi"), states.join(alive, "task_uid", "left_anti")


def message(states: DataFrame, kind: str, me: str) -> DataFrame:
    """The states that a message carries: epochs all, others the sender's own."""
    return states if kind in EPOCHS else states.where(F.col("task_uid") == me)


def coalesced(log: DataFrame, window_us: int, time: str) -> DataFrame:
    """What a buffering publisher sends: of a task's REGULAR messages in a window the last, all others as they come."""
    regular = log.where("message_type = 'REGULAR'")
    rest = [c for c in log.columns if c != "task_uid"]
    slot = F.floor(F.col(time) / window_us).alias("_slot")
    last = regular.groupBy("task_uid", slot).agg(F.max_by(F.struct(*rest), "log_offset").alias("_x"))
    return last.select("task_uid", *[F.col(f"_x.{c}").alias(c) for c in rest]).unionByName(log.where("message_type <> 'REGULAR'").select("task_uid", *rest))


def rebalance_bursts(events: DataFrame, gap: str = "1 second", time: str = "ts", *by: str) -> DataFrame:
    """Rebalance events that a delay, started anew by each, would join to one action: starts and sizes of the bursts, by group."""
    return events.groupBy(*by, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("events")).select(*by, F.col("w.start").alias("started"), "events")
