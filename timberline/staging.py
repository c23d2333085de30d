"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``; only a local master may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="timberline-"))
        base = _LOCAL[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as it was computed once: a lost executor, or a second reader, sees the same rows."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few short columns that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and counted; it is broadcast if it has ``BROADCAST_ROWS`` rows at most, else Spark joins by shuffling."""
    from pyspark.sql import functions as F

    df = written(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
