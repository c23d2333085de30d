"""Ingestion as one streaming query: files to lines to records to the day-partitioned store.

At least once into an idempotent sink: store and dead letters of a batch appear
together, replace themselves if it is written again, the last write of an id
wins on reading, and the checkpoint moves on only after that.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import timberline
from timberline.functions.framing import frame, frame_files
from timberline.functions.ids import log_id
from timberline.functions.levels import parse_level
from timberline.functions.text import unwrapped
from timberline.functions.timestamps import parse_timestamp
from timberline.operators import store, storeindex, transaction, validate


@dataclass(frozen=True)
class Config:
    store: str
    dead_letters: str
    checkpoint: str
    service: str
    agent_id: str = "agent-1"
    host: str = ""
    container_lines: bool = False
    files_per_trigger: int = 1000
    #: Files of a batch up to this size are read whole, larger ones in blocks.
    whole_bytes: int = 64 << 20
    #: Whether a batch's files get entries in the store's index at once; else they get them when their days are merged, and are read by every search until then.
    indexed: bool = False
    #: Set apart batches of a stream whose checkpoint was lost from those of the one before.
    run: str = "0"


def records(lines: DataFrame, config: Config, now: Column) -> DataFrame:
    """Log entries of framed lines (source, epoch, offset, line)."""
    if config.container_lines:
        lines = unwrapped(lines, F.col("line"), "u").where("NOT u.drop").withColumns({"line": F.col("u.message"), "at": F.col("u.time")}).drop("u")
    else:
        lines = lines.withColumn("at", F.lit(None).cast("timestamp"))
    return lines.select(
        log_id(F.lit(config.agent_id), F.col("source"), F.col("epoch"), F.col("offset")).alias("id"),
        F.lit(config.service).alias("service"),
        F.coalesce("at", parse_timestamp(F.col("line"), now), now).alias("timestamp"),
        now.alias("observed_at"),
        parse_level(F.col("line")).alias("level"),
        F.col("line").alias("message"),
        F.lit(config.host or None).cast("string").alias("host"),
        F.lit(config.agent_id).alias("agent_id"),
        "source", "offset", "epoch",
    )


def write_both(spark: SparkSession, good: DataFrame, dead: DataFrame, batch_id: int | str, config: Config) -> None:
    """Stored entries and dead letters of a batch, which appear together; a batch that is written again replaces itself."""
    name = f"{config.run}-{batch_id}"
    both = transaction.Transaction(spark, config.store, name)
    try:
        dead.write.parquet(both.staged("dead"))
        store.batch_rows(good, name).write.partitionBy("event_date", "batch").parquet(both.staged("store"))
    except BaseException:
        both.abort()
        raise
    own = f"{config.dead_letters}/batch={name}"
    both.commit({"store": (config.store, "event_date=*/batch=*"), "dead": (own, "")}, [f"{config.store}/event_date=*/batch={name}"])
    if config.indexed:
        storeindex.add(spark, config.store, name)


def write_batch(spark: SparkSession, batch: DataFrame, batch_id: int | str, config: Config) -> None:
    """Accepted rows go to the store; rejected ones, as they came and with their reason, to a folder of the batch's own."""
    now = F.current_timestamp()
    batch = batch.persist()
    try:
        good, bad = validate.route(batch, now, F.lit(config.service))
        write_both(spark, store.stored(good, now), bad.select("id", "reason", "source", "epoch", "offset", "message"), batch_id, config)
    finally:
        batch.unpersist()


def prepare(spark: SparkSession, config: Config) -> None:
    """A store to write to; what a run that ended early has decided is carried out."""
    timberline.importable(spark)
    store.create(spark, config.store)
    transaction.recover(spark, config.store)


def start(spark: SparkSession, source: str, config: Config, once: bool = True):
    """Start ingesting closed files under ``source``, each once; with ``once``, stop when all present files are in.

    The stream itself carries names and lengths only. Files of a batch are read
    whole, side by side, and large ones in blocks. Files that still grow are for ``tail``.
    """
    prepare(spark, config)
    files = (
        spark.readStream.format("binaryFile").option("maxFilesPerTrigger", config.files_per_trigger)
        .schema("path string, modificationTime timestamp, length long, content binary").load(source).select("path", "length")
    )

    def batch(names: DataFrame, i: int) -> None:
        small, large = [], []
        for r in names.collect():  # as many as the trigger takes
            (small if r.length <= config.whole_bytes else large).append(r.path)
        session, lines = names.sparkSession, []
        if small:
            whole = session.read.format("binaryFile").load(small)
            lines.append(frame(whole, "path", "content").select(F.col("path").alias("source"), "offset", "line"))
        if large:
            lines.append(frame_files(session, large))
        if lines:
            rows = reduce(DataFrame.unionByName, lines).withColumn("epoch", F.lit(0).cast("bigint"))
            write_batch(session, records(rows, config, F.current_timestamp()), i, config)

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", config.checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def _writer(lines: DataFrame, config: Config):
    entries = records(lines, config, F.current_timestamp())
    return entries.writeStream.foreachBatch(lambda b, i: write_batch(b.sparkSession, b, i, config)).option("checkpointLocation", config.checkpoint)


def tail(spark: SparkSession, pattern: str, config: Config, poll: str = "100 milliseconds", read_bytes: int = 8 << 20):
    """Start tailing the files that match ``pattern``: lines appended later, new files, and rotated or truncated ones under the next epoch.

    Executors read the files, in ranges that the driver plans.
    """
    from timberline.sources.tailfiles import TailFilesSource

    prepare(spark, config)
    spark.dataSource.register(TailFilesSource)
    source = spark.readStream.format("tailfiles").option("path", pattern).option("progress", f"{config.checkpoint}/tail-position.json")
    lines = source.option("read_bytes", read_bytes).load()
    return _writer(lines, config).trigger(processingTime=poll).start()


def index(spark: SparkSession, raw: DataFrame, config: Config):
    """Start storing the records of a log (value, topic, partition, source_offset); what can't be read or is invalid goes to the dead letters with its place.

    Levels and times that a record's sender left open are taken from its line.
    """
    prepare(spark, config)

    def batch(rows: DataFrame, i: int) -> None:
        now = F.current_timestamp()
        rows = rows.persist()
        try:
            good, dead = validate.decode(rows, now)
            open_time = F.col("timestamp") == F.col("observed_at")
            good = good.withColumns({
                "level": F.when(F.col("level") == "unknown", parse_level(F.col("message"))).otherwise(F.col("level")),
                "timestamp": F.when(open_time, F.coalesce(parse_timestamp(F.col("message"), F.col("observed_at")), F.col("timestamp"))).otherwise(F.col("timestamp")),
            })
            write_both(rows.sparkSession, store.stored(good, now), dead, i, config)
        finally:
            rows.unpersist()

    return raw.writeStream.foreachBatch(batch).option("checkpointLocation", config.checkpoint).trigger(processingTime="1 second").start()


def load(spark: SparkSession, path: str, config: Config) -> None:
    """Ingest files of any size under ``path`` in one batch, split into blocks; doing it again changes nothing."""
    prepare(spark, config)
    lines = frame_files(spark, path).withColumn("epoch", F.lit(0).cast("bigint"))
    write_batch(spark, records(lines, config, F.current_timestamp()), f"load-{zlib.crc32(path.encode()):08x}", config)


def drain(query, grace: float = 30.0) -> bool:
    """Stop a stream gracefully: a batch in progress, and what has arrived, gets ``grace`` seconds; whether that was enough."""
    import threading

    def rest() -> None:
        query.processAllAvailable()
        query.processAllAvailable()  # a look for new data that began before this call may have ended the first wait

    waiting = threading.Thread(target=rest, daemon=True)
    waiting.start()
    waiting.join(grace)
    done = not waiting.is_alive()
    query.stop()
    return done


def deduplicated(entries: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Entries without repeated ids within the delay; the sink absorbs what comes later."""
    return entries.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["id"])
