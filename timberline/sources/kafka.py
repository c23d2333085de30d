"""Kafka as source and sink, where its connector is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001  any failure to load means that it isn't there
        return False


def options(servers: str, topic: str, start: str, rows_per_trigger: int | None = None) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, "failOnDataLoss": "true"}
    return out | ({"maxOffsetsPerTrigger": str(rows_per_trigger)} if rows_per_trigger else {})


def records(spark: SparkSession, servers: str, topic: str, start: str = "earliest", rows_per_trigger: int | None = None) -> DataFrame:
    """value, topic, partition and source_offset: from the start for the store, from ``latest`` for tail and alerts."""
    if not available(spark):
        raise RuntimeError("the Kafka connector is not on the class path")
    raw = spark.readStream.format("kafka").options(**options(servers, topic, start, rows_per_trigger)).load()
    return raw.select("value", "topic", "partition", F.col("offset").alias("source_offset"))


def producer(entries: DataFrame) -> DataFrame:
    """Key (the service) and JSON value of every entry."""
    return entries.select(F.col("service").alias("key"), F.to_json(F.struct("*")).alias("value"))


def lag(progress: dict) -> dict[str, int]:
    """Rows behind per partition, from a streaming query's progress."""
    out: dict[str, int] = {}
    for source in progress.get("sources", []):
        end, latest = source.get("endOffset") or {}, source.get("latestOffset") or {}
        for topic, parts in latest.items():
            if isinstance(parts, dict):
                for p, n in parts.items():
                    out[f"{topic}-{p}"] = int(n) - int((end.get(topic) or {}).get(p, 0))
    return out
