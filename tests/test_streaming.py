import json

import pytest
from pyspark.sql import functions as F

from timberline.operators import audit, store
from timberline.operators.alerts import Rule
from timberline.operators.tail import TailFilter
from timberline.sources.tables import LOG_SCHEMA
from timberline.streaming import alerting, hub, ingest


def hdfs_lines(n):
    out = []
    for i in range(n):
        sec = 20 * 3600 + i // 3
        level = "ERROR" if i % 50 == 0 else "WARN" if i % 10 == 0 else "INFO"
        out.append(f"081109 {sec // 3600:02d}{sec // 60 % 60:02d}{sec % 60:02d} {100 + i} {level} dfs.DataNode$PacketResponder: block blk_{i} terminating")
    return out


def config(tmp_path, **more):
    base = f"file://{tmp_path}"
    return ingest.Config(f"{base}/store", f"{base}/dead", f"{base}/checkpoint", "hdfs", **more)


def test_ingest_is_complete_and_restartable(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = hdfs_lines(1000)
    (source / "a.log").write_text("\n".join(lines[:600]) + "\n\n" + "x" * 70_000 + "\n")
    c = config(tmp_path)
    ingest.start(spark, f"file://{source}", c).awaitTermination()
    (source / "b.log").write_text("\n".join(lines[600:]))
    ingest.start(spark, f"file://{source}", c).awaitTermination()
    got = store.read(spark, c.store)
    assert got.where("message LIKE '081109%'").count() == 1000 and got.select("id").distinct().count() == got.count()
    assert got.where("level = 'error'").count() == 20
    assert got.where("timestamp >= '2008-11-09 20:00:00' AND timestamp < '2008-11-09 20:01:00' AND message LIKE '081109%'").count() == 180
    # a lost checkpoint delivers all again; the store absorbs it
    again = ingest.Config(c.store, c.dead_letters + "2", c.checkpoint + "2", "hdfs", run="1")
    before = got.count()
    expected = got.where("message LIKE '081109%'").select("id").collect()
    ingest.start(spark, f"file://{source}", again).awaitTermination()
    after = store.current(spark, c.store)
    kept = after.where("message LIKE '081109%'")
    assert kept.count() == 1000 and audit.missing(spark.createDataFrame(expected), kept).count() == 0 and before == store.current(spark, c.store).count()


def test_container_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [json.dumps({"log": ("fail: " if i % 5 == 0 else "ok ") + str(i) + "\n", "stream": "stdout", "time": f"2026-01-01T00:00:{i:02d}Z"}) for i in range(20)]
    (source / "c.log").write_text("\n".join([*rows, json.dumps({"log": "\n", "stream": "stdout", "time": "2026-01-01T00:00:59Z"}), "not json"]) + "\n")
    c = config(tmp_path, container_lines=True, host="payment")
    ingest.start(spark, f"file://{source}", c).awaitTermination()
    got = store.read(spark, c.store)
    assert got.count() == 21 and got.where("level = 'error'").count() == 4 and got.where("host = 'payment'").count() == 21


def test_streaming_alerts_match_the_fold(spark, tmp_path):
    path = f"file://{tmp_path}/logs"
    rule = Rule(window=3, baseline=12, min_errors=4, ratio=2.0, cooldown=5, bucket=1_000_000)
    counts = [1, 0, 0, 5, 6, 0, 0, 0, 0, 0, 9, 1, 0, 0, 0, 0, 1]
    rows = [("a", 1_000 + b) for b, n in enumerate(counts) for _ in range(n)]
    df = spark.createDataFrame(rows, "service string, b long").select("service", F.timestamp_micros(F.col("b") * 1_000_000).alias("observed_at"), F.lit("error").alias("level"))
    df.coalesce(1).write.parquet(path)
    detector, want = alerting.Detector(rule), []
    for b, n in enumerate(counts):
        if n:
            detector.observe(1_000 + b, n)
        if (got := detector.evaluate(1_000 + b)) is not None:
            want.append((1_000 + b, got[0]))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema("service string, observed_at timestamp, level string").parquet(path)
        q = alerting.alerts(stream, rule).writeStream.format("memory").queryName("alerts_out").outputMode("update").option("checkpointLocation", f"{path}-ck").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert [(r.bucket, r.kind) for r in spark.table("alerts_out").orderBy("bucket").collect()] == want and want


def test_a_spike_followed_by_silence_is_resolved_and_forgotten(spark, tmp_path):
    import time

    path = f"file://{tmp_path}/logs"
    rule = Rule(window=3, baseline=6, min_errors=4, ratio=2.0, cooldown=5, bucket=1_000_000)
    spark.range(6).select(F.lit("a").alias("service"), F.current_timestamp().alias("observed_at"), F.lit("error").alias("level")).coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    q = None
    try:
        stream = spark.readStream.schema("service string, observed_at timestamp, level string").parquet(path)
        q = alerting.alerts(stream, rule).writeStream.format("memory").queryName("silent_out").outputMode("update").option("checkpointLocation", f"{path}-ck").trigger(processingTime="1 second").start()
        end = time.time() + 60
        while time.time() < end and q.isActive and not (spark.table("silent_out").where("kind = 'resolved'").count() and q.lastProgress.stateOperators[0].numRowsTotal == 0):
            time.sleep(0.5)
        left = q.lastProgress.stateOperators[0].numRowsTotal
    finally:
        if q is not None:
            q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    (fired, resolved) = spark.table("silent_out").orderBy("bucket").collect()
    assert (fired.kind, fired.errors, resolved.kind, resolved.errors) == ("firing", 6, "resolved", 0) and resolved.bucket == fired.bucket + rule.window
    assert left == 0


def test_dedup_within_watermark(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    spark.range(10).select(F.col("id") % 5).toDF("id").withColumn("observed_at", F.current_timestamp()).write.parquet(path)
    stream = spark.readStream.schema("id long, observed_at timestamp").parquet(path)
    q = ingest.deduplicated(stream).writeStream.format("memory").queryName("dedup_out").option("checkpointLocation", f"{path}-ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_out").count() == 5


def test_tail_source_follows_truncation(spark, tmp_path):
    from timberline.sources.tailfile import TailFileSource, TailReader

    f = tmp_path / "x.log"
    f.write_text("one\ntwo\nhalf")
    reader = TailReader(str(tmp_path / "*.log"))
    rows, at = reader.read({})
    assert [(r[1], r[2], r[3]) for r in rows] == [(0, 0, "one"), (0, 4, "two")]
    with f.open("a") as h:
        h.write(" done\n")
    rows, at2 = reader.read(at)
    assert [(r[2], r[3]) for r in rows] == [(8, "half done")]
    assert [r[3] for r in reader.readBetweenOffsets(at, at2)] == ["half done"]
    f.write_text("new\n")
    rows, at3 = reader.read(at2)
    assert [(r[1], r[2], r[3]) for r in rows] == [(1, 0, "new")]
    spark.dataSource.register(TailFileSource)
    q = spark.readStream.format("tailfile").option("path", str(tmp_path / "*.log")).load().writeStream.format("memory").queryName("tail_out").option("checkpointLocation", f"file://{tmp_path}/ck").start()
    try:
        q.processAllAvailable()
        assert [r.line for r in spark.table("tail_out").collect()] == ["new"]
    finally:
        q.stop()


def test_tail_ingest_follows_appends_and_rotation(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines, f = hdfs_lines(5000), folder / "a.log"
    f.write_text("\n".join(lines[:2000]) + "\n")
    c = config(tmp_path)
    q = ingest.tail(spark, str(folder / "*.log"), c, read_bytes=50_000)
    try:
        q.processAllAvailable()
        with f.open("a") as h:
            h.write("\n".join(lines[2000:3000]))  # its last line lacks the line feed
        f.rename(folder / "a.log.1")
        f.write_text("\n".join(lines[3000:4000]) + "\n")
        q.processAllAvailable()
        with f.open("a") as h:
            h.write("\n".join(lines[4000:]) + "\n\n")
        (folder / "b.log").write_text("x" * 70_000 + "\n" + lines[0] + "\n")
        assert ingest.drain(q, 120)
    finally:
        q.stop()
    got = store.current(spark, c.store)
    own = got.where("source LIKE '%a.log'")
    assert own.count() == 5000 == own.select("message").distinct().count() and got.where("source LIKE '%b.log'").count() == 3
    assert own.where("epoch = 0").count() == 3000 and own.where("level = 'error'").count() == 100
    assert own.where("timestamp >= '2008-11-09 20:00:00' AND timestamp < '2008-11-09 20:01:00'").count() == 180
    assert spark.read.parquet(c.dead_letters).count() == 0


def test_rejected_rows_keep_what_they_came_with(spark, tmp_path):
    c = config(tmp_path)
    store.create(spark, c.store)
    rows = [(None, "m0", 0), ("same", "m1", 1), ("same", "m2", 2), ("0" * 32, "fine", 3)]
    batch = spark.createDataFrame(rows, "id string, message string, offset long").select(
        "id", F.lit("s").alias("service"), F.current_timestamp().alias("timestamp"), F.current_timestamp().alias("observed_at"), F.lit("info").alias("level"), "message",
        F.lit(None).cast("string").alias("host"), F.lit("a").alias("agent_id"), F.lit("/f").alias("source"), "offset", F.lit(0).cast("bigint").alias("epoch"),
    )
    for _ in range(2):  # a batch that is written again replaces itself
        ingest.write_batch(spark, batch, 7, c)
    dead = spark.read.parquet(c.dead_letters).orderBy("offset").collect()
    assert [(r.id, r.message) for r in dead] == [(None, "m0"), ("same", "m1"), ("same", "m2")] and store.read(spark, c.store).count() == 1


def test_load_of_files_in_blocks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.log").write_text("\n".join(hdfs_lines(2000)))
    c = config(tmp_path)
    for _ in range(2):
        ingest.load(spark, f"file://{folder}", c)
    got = store.read(spark, c.store)
    assert got.count() == 2000 == got.select("id").distinct().count()


def test_hub_buffers():
    h = hub.Hub(max_clients=2)
    slow, fast = h.subscribe("slow", TailFilter(), 3), h.subscribe("fast", TailFilter(), 100)
    with pytest.raises(hub.TooManyClients):
        h.subscribe("x", TailFilter())
    for i in range(50):
        h.publish({"id": str(i), "service": "s", "level": "info", "message": "m", "host": None})
    got, dropped = slow.take()
    assert (len(got), dropped) == (3, 47) and slow.take() == ([], 0) and len(fast.take()[0]) == 50
    assert (h.consumed, h.delivered, h.dropped) == (50, 53, 47)
    assert "id: " not in hub.sse([{"id": "1"}]) and f"id: {'a' * 32}" in hub.sse([{"id": "a" * 32}], 2) and "dropped" in hub.sse([], 2)


def test_log_schema_is_complete():
    assert LOG_SCHEMA.names == ["id", "service", "timestamp", "observed_at", "indexed_at", "level", "message", "host", "agent_id", "source", "offset", "epoch"]
