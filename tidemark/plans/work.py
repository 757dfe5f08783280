"""Folders and checkpoints of operators that go round by round."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workdir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; in local mode a temporary one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base}/tidemark-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(workdir(df.sparkSession))
    return df.checkpoint()
