"""The log table: its schema, and the log records that the driver's tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import timberline
from timberline.functions.ids import log_id

#: Fixed and strict: what a stored record has.
LOG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("service", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("observed_at", T.TimestampType()),
    T.StructField("indexed_at", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("agent_id", T.StringType()),
    T.StructField("source", T.StringType(), False),
    T.StructField("offset", T.LongType()),
    T.StructField("epoch", T.LongType()),
])

LOGS_SQL = """
logs AS (
  SELECT substring(sha256(
           unhex('0000000000000007') || encode('agent-1') || unhex('0000000000000013') || encode('/var/log/events.log')
           || unhex('0000000000000000') || unhex(lpad(hex(event_id), 16, '0'))), 1, 32) AS id,
         'svc-' || (user_id % 5) AS service,
         ts AS "timestamp",
         ts + to_milliseconds(event_id % 500) AS observed_at,
         ts + to_milliseconds(event_id % 500 + event_id * 7919 % 2000) AS indexed_at,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warn' WHEN 'signup' THEN 'debug' ELSE 'info' END AS level,
         event_type || ' user=' || user_id || ' props=' || props AS message,
         'host-' || (user_id % 3) AS host,
         'agent-1' AS agent_id, '/var/log/events.log' AS source, event_id AS "offset", 0 AS epoch,
         event_type, value
  FROM events
)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    timberline.importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logs_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of the events table; scans only the columns that a query needs."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    agent, source = F.lit("agent-1"), F.lit("/var/log/events.log")
    observed = F.timestamp_add("MILLISECOND", F.col("event_id") % 500, ts)
    level = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "warn").when(F.col("event_type") == "signup", "debug").otherwise("info")
    return e.select(
        log_id(agent, source, F.lit(0), F.col("event_id")).alias("id"),
        F.concat(F.lit("svc-"), F.col("user_id") % 5).alias("service"),
        ts.alias("timestamp"),
        observed.alias("observed_at"),
        F.timestamp_add("MILLISECOND", F.col("event_id") * 7919 % 2000, observed).alias("indexed_at"),
        level.alias("level"),
        F.concat("event_type", F.lit(" user="), "user_id", F.lit(" props="), "props").alias("message"),
        F.concat(F.lit("host-"), F.col("user_id") % 3).alias("host"),
        agent.alias("agent_id"), source.alias("source"),
        F.col("event_id").alias("offset"), F.lit(0).cast("bigint").alias("epoch"),
        F.to_date(ts).alias("event_date"),
        "event_type", "value",
    )
