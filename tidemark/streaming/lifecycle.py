"""A partition's life as a stateful stream, keyed by its token.

Events: token, kind (created, ready, scheduled, running, record, ack, finish, error), uid, at_us. A partition that is told to
finish does so only when its last record is acknowledged, whichever comes first; without records at once. A retriable error
makes it READY again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

import tidemark

from ..operators.lineage import CREATED, FINISHED, READY, RUNNING, SCHEDULED

OUT = "token string, state long, at_us long, pending boolean"
STATE = "state long, last_record string, last_ack string, pending boolean, at_us long"
_TO = {"created": CREATED, "ready": READY, "scheduled": SCHEDULED, "running": RUNNING, "error": READY}


def step(state: tuple, kind: str, uid: str | None, at: int) -> tuple:
    """The state (state, last record, last acknowledged, pending, since) after one event."""
    now, record, ack, pending, since = state
    if now == FINISHED:
        return state
    if kind == "record":
        record = max(record or "", uid)
    elif kind == "ack":
        ack = max(ack or "", uid)
    elif kind == "finish":
        pending = True
    elif kind in _TO:
        now, since = _TO[kind], at
        if kind == "error":
            pending = False
    if pending and (record is None or ack == record):
        now, pending, since = FINISHED, False, at
    return now, record, ack, pending, since


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    have = state.get if state.exists else (CREATED, None, None, False, 0)
    rows = pd.concat(list(frames)).sort_values(["at_us", "seq"], kind="stable")
    out, at = [], have[4]
    for kind, uid, when in rows[["kind", "uid", "at_us"]].itertuples(index=False, name=None):
        before = have[0]
        have = step(have, kind, None if pd.isna(uid) else uid, int(when))
        if have[0] != before or kind == "created":
            out.append((key[0], have[0], int(when), have[3]))
        at = int(when)
    state.update((int(have[0]), have[1], have[2], bool(have[3]), int(at)))
    yield pd.DataFrame(out, columns=["token", "state", "at_us", "pending"])


def lifecycle(events: DataFrame) -> DataFrame:
    """The changes of state that a stream of events (token, seq, kind, uid, at_us) makes."""
    return events.groupBy("token").applyInPandasWithState(_advance, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def lifecycle_batch(events: DataFrame) -> DataFrame:
    """The same over a table: token and the state after all its events."""

    cloudpickle.register_pickle_by_value(tidemark)  # executors need not have the package installed

    def whole(key, rows: pd.DataFrame) -> pd.DataFrame:
        have = (CREATED, None, None, False, 0)
        for kind, uid, when in rows.sort_values(["at_us", "seq"], kind="stable")[["kind", "uid", "at_us"]].itertuples(index=False, name=None):
            have = step(have, kind, None if pd.isna(uid) else uid, int(when))
        return pd.DataFrame([(key[0], have[0], have[4], have[3])], columns=["token", "state", "at_us", "pending"])

    return events.groupBy("token").applyInPandas(whole, OUT)


def finish_ready(records: DataFrame, acks: DataFrame, finishing: DataFrame) -> DataFrame:
    """token, finished of partitions told to finish: whether the last record is acknowledged, or there was none.

    The relation behind the stateful form; records and acks: token, uid.
    """
    last = records.groupBy("token").agg(F.max("uid").alias("_r")).join(acks.groupBy("token").agg(F.max("uid").alias("_a")), "token", "left")
    return finishing.select("token").distinct().join(last, "token", "left").select("token", (F.col("_r").isNull() | F.coalesce(F.col("_a") == F.col("_r"), F.lit(False))).alias("finished"))


def overdue(finishing: DataFrame, now_us: int, after_us: int = 300_000_000) -> DataFrame:
    """Partitions (token, since_us) that have waited too long to finish: a watchdog fails the query over them."""
    return finishing.where(F.lit(now_us) - F.col("since_us") > after_us)
