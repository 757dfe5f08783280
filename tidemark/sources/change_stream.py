"""Reading a change stream: a native scan, and a Python data source for batch and streaming.

The log is Parquet with columns partition_token, commit_us and record (JSON text). One cursor reads one partition between two
times; the root partition's token stands for none. A stream's position is a time for each partition, as partitions advance on their
own: within a partition records come in the order of their times, and those of one time together, but a partition may lie behind
another. A batch holds what lies between two positions, and a heartbeat for every partition that was silent.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

import tidemark

from ..operators.decode import ROOT

SCHEMA = "partition_token string, commit_us bigint, record string"


def scan(spark: SparkSession, path: str, start_us: int | None = None, end_us: int | None = None, tokens: list[str] | None = None) -> DataFrame:
    """The records of [start, end] and of the tokens, by Spark's own reader: times and tokens are pushed to the files.

    The root's token asks for the records that have no token.
    """
    out = spark.read.parquet(path).select("partition_token", "commit_us", "record")
    if start_us is not None:
        out = out.where(F.col("commit_us") >= start_us)
    if end_us is not None:
        out = out.where(F.col("commit_us") <= end_us)
    if tokens is not None:
        asked = F.col("partition_token").isin([t for t in tokens if t != ROOT])
        out = out.where(asked | F.col("partition_token").isNull() if ROOT in tokens else asked)
    return out


class Cursor(InputPartition):
    """The records of (start, end] of a partition; beat: when a heartbeat says that there were none."""

    def __init__(self, token: str | None, start: int, end: int, beat: int | None):
        self.token, self.start, self.end, self.beat = token, start, end, beat


class _Log:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.start = int(options.get("start_us", 0))
        self.end = int(options["end_us"]) if options.get("end_us") else 2**62
        self.max_rows = int(options.get("max_rows", 10_000))
        self.tokens = set(json.loads(options["tokens"])) if options.get("tokens") else None
        self.files: dict[str, dict[str, int]] = {}

    def positions(self) -> dict[str, int]:
        """The last time of each partition (the root's token for none). Files do not change, so each is looked at once, by the statistics of
        its row groups where one holds a single partition and ends in time, else by its two columns, batch by batch."""
        last: dict[str, int] = {}
        for file in ds.dataset(self.path).get_fragments():
            if file.path not in self.files:
                self.files[file.path] = self._last(file)
            for token, at in self.files[file.path].items():
                last[token] = max(at, last.get(token, at))
        return last if self.tokens is None else {t: at for t, at in last.items() if t in self.tokens}

    def _last(self, file) -> dict[str, int]:
        last: dict[str, int] = {}
        for group in file.split_by_row_group():
            known = group.row_groups[0].statistics or {}
            token, time = known.get("partition_token") or {}, known.get("commit_us") or {}
            if token.get("min") is not None and token.get("min") == token.get("max") and time.get("max") is not None and time["max"] <= self.end and not self._nulls(group):
                last[token["min"]] = max(time["max"], last.get(token["min"], time["max"]))
                continue
            batches = group.scanner(columns=["partition_token", "commit_us"], filter=pc.field("commit_us") <= self.end, batch_size=100_000).to_batches()
            for batch in batches:
                for r in pa.table(batch).group_by("partition_token").aggregate([("commit_us", "max")]).to_pylist():
                    name = ROOT if r["partition_token"] is None else r["partition_token"]
                    last[name] = max(r["commit_us_max"], last.get(name, r["commit_us_max"]))
        return last

    @staticmethod
    def _nulls(group) -> bool:
        """Whether a row group has, or may have, rows without a token: statistics leave them out."""
        column = group.metadata.schema.names.index("partition_token")
        stats = group.metadata.row_group(group.row_groups[0].id).column(column).statistics
        return stats is None or not stats.has_null_count or stats.null_count > 0

    def read(self, cursor: Cursor):
        """Rows of a cursor's (start, end], max_rows at a time; its heartbeat where nothing came."""
        kinds = pa.schema([("partition_token", pa.string()), ("commit_us", pa.int64()), ("record", pa.string())])
        token = pc.field("partition_token")
        mine = token.is_null() if cursor.token is None else token == cursor.token
        where = mine & (pc.field("commit_us") > cursor.start) & (pc.field("commit_us") <= cursor.end)
        some = False
        if cursor.end > cursor.start:
            for batch in ds.dataset(self.path).scanner(columns=kinds.names, filter=where, batch_size=self.max_rows).to_batches():
                if batch.num_rows:
                    some = True
                    yield batch.cast(kinds)
        if cursor.beat is not None and not some:
            beat = json.dumps({"heartbeat_record": {"timestamp": _instant(cursor.beat)}})
            yield pa.RecordBatch.from_arrays([pa.array([cursor.token], pa.string()), pa.array([cursor.beat], pa.int64()), pa.array([beat])], schema=kinds)


def _instant(us: int) -> str:
    return datetime.fromtimestamp(us // 1_000_000, UTC).strftime("%Y-%m-%dT%H:%M:%S.") + f"{us % 1_000_000:06d}Z"


def _token(name: str) -> str | None:
    return None if name == ROOT else name


class ChangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.log = _Log(options)

    def partitions(self):
        last = self.log.positions()
        return [Cursor(_token(t), self.log.start - 1, last[t], None) for t in sorted(last)] or [Cursor(None, 0, 0, None)]

    def read(self, partition: Cursor):
        return self.log.read(partition)


class ChangeStreamReader(DataSourceStreamReader):
    """Positions are {"at": {token: time}}: a partition that is not in it is read from its start."""

    def __init__(self, options: dict):
        self.log = _Log(options)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"at": {}}

    def latestOffset(self) -> dict:  # noqa: N802
        """The last times there are: the same after a restart, whatever was read before."""
        return {"at": dict(sorted(self.log.positions().items()))}

    def partitions(self, start: dict, end: dict):
        """A cursor for each partition. A silent one's heartbeat tells the latest time of any, which is not a position: what comes late is
        still read."""
        beat = max(end["at"].values(), default=None)
        return [Cursor(_token(t), start["at"].get(t, self.log.start - 1), at, beat) for t, at in end["at"].items()] or [Cursor(None, 0, 0, None)]

    def read(self, partition: Cursor):
        return self.log.read(partition)

    def commit(self, end: dict) -> None:
        """The checkpoint keeps positions; the log is not trimmed."""


class ChangeStreamSource(DataSource):
    """format tidemark_changes; options path, start_us, end_us (inclusive), tokens (a JSON list), max_rows (that a reader holds at once)."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_changes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ChangeReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return ChangeStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    cloudpickle.register_pickle_by_value(tidemark)  # executors need not have the package installed
    spark.dataSource.register(ChangeStreamSource)
