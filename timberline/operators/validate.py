"""Validation and routing of incoming records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.functions.ids import valid_log_id
from timberline.functions.levels import LEVELS

MAX_MESSAGE_BYTES = 65_536

# The reasons, in the order in which they are checked.
REASONS = (
    "invalid id", "empty message", "message too large", "message is not valid UTF-8", "missing or invalid timestamp",
    "timestamp too far in the future", "missing or invalid observed_at", "unknown level", "missing source",
)


def reason(now: Column) -> Column:
    """The first reason to reject a record; null if there is none. The level may be an ordinal or a name."""
    level = F.col("level").cast("string")
    known = level.isin(*LEVELS, *(str(i) for i in range(len(LEVELS))))
    checks = (
        ~F.coalesce(valid_log_id(F.col("id")), F.lit(False)),
        F.coalesce(F.col("message"), F.lit("")) == "",
        F.octet_length("message") > MAX_MESSAGE_BYTES,
        ~F.is_valid_utf8("message"),
        F.col("timestamp").isNull(),
        F.col("timestamp") > now + F.expr("INTERVAL '24' HOUR"),
        F.col("observed_at").isNull(),
        ~F.coalesce(known, F.lit(False)),
        F.coalesce(F.col("source"), F.lit("")) == "",
    )
    out = F.when(checks[0], REASONS[0])
    for check, name in zip(checks[1:], REASONS[1:]):
        out = out.when(check, name)
    return out


def route(records: DataFrame, now: Column, service: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): accepted rows carry the authenticated service, rejected ones all they came with and a reason."""
    checked = records.withColumn("reason", reason(now))
    accepted = checked.where("reason IS NULL").drop("reason").withColumn("service", service)
    return accepted, checked.where("reason IS NOT NULL")


def decode(raw: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(records, dead letters) of JSON payloads in column value (binary); dead letters keep the bytes.

    Positions (topic, partition, offset) go along with dead letters.
    """
    schema = "id string, service string, timestamp timestamp, observed_at timestamp, level string, message string, host string, agent_id string, source string, offset bigint, epoch bigint"
    parsed = raw.withColumn("r", F.from_json(F.col("value").cast("string"), schema))
    empty = F.col("r").isNull() | F.forall(F.array(*(F.col(f"r.{c}").isNotNull() for c in ("id", "service", "message", "source"))), lambda x: ~x)
    flat = parsed.select("*", *(F.col(f"r.{c}").alias(c) if c != "offset" else F.col("r.offset").alias("line_offset") for c in raw.sparkSession.createDataFrame([], schema).columns))
    verdict = F.when(empty, F.lit("unparseable: no record")).otherwise(
        F.concat(F.lit("invalid: "), F.coalesce(reason(now), F.when(F.coalesce(F.col("service"), F.lit("")) == "", F.lit("missing service"))))
    )
    flat = flat.withColumn("error", verdict)
    good = flat.where("error IS NULL").drop("error", "r", "value", "topic", "partition", "source_offset").withColumnRenamed("line_offset", "offset")
    dead = flat.where("error IS NOT NULL").select("value", "error", F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), "source_offset")
    return good, dead
