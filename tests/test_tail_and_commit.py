"""Tailing in planned ranges, and batches whose tables appear together."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import config, hdfs_lines
from timberline.functions.framing import lines_of
from timberline.operators import store, transaction
from timberline.sources.tailfiles import TailFilesReader
from timberline.streaming import ingest


def rows_of(reader, start, end):
    """What executors read between two positions; positions and ranges go through JSON and pickling as in Spark."""
    import pickle

    start, end = (json.loads(json.dumps(x)) for x in (start, end))
    out = []
    for p in reader.partitions(start, end):
        for b in reader.read(pickle.loads(pickle.dumps(p))):
            out += [tuple(r.values()) for r in b.to_pylist()]
    return out


def reader(tmp_path, **more):
    return TailFilesReader(str(tmp_path / "*.log"), str(tmp_path / "position.json"), **more)


def test_ranges_are_read_like_whole_files(tmp_path):
    """Any split gives the lines of one pass: long lines in pieces, carriage returns, empty lines, broken text, a last line that isn't whole."""
    data = b"one\r\n\ntwo\n" + b"y" * 250 + b"\n" + b"\n".join(b"%d \xff x" % i for i in range(300)) + b"\n" + b"z" * 130 + b"half"
    (tmp_path / "a.log").write_bytes(data)
    want, used = lines_of(data, 0, 50)
    for split, at_once in ((7, 64), (100, 10_000), (10_000, 333), (1 << 20, 1 << 20)):
        r = reader(tmp_path, max_line=50, read_bytes=at_once, split_bytes=split)
        r.position, start, got = {}, {}, []
        while (end := r.latestOffset()) != start:
            got += rows_of(r, start, end)
            assert end[str(tmp_path / "a.log")][0][2] - (start or {str(tmp_path / "a.log"): [[0, 0, 0]]})[str(tmp_path / "a.log")][0][2] <= max(at_once, 51)
            start = end
        assert [(o, x) for _, _, o, x in sorted(got, key=lambda r: r[2])] == [(o, x.decode("utf-8", "replace")) for o, x in want]
        assert start[str(tmp_path / "a.log")][0][2] == used
    assert len(reader(tmp_path, max_line=50, split_bytes=100).partitions({}, start)) > 20


def test_rotation_truncation_and_restart(tmp_path):
    """Epochs follow a file that is moved away, truncated and deleted; a new reader goes on where the last one was, and replays give the same rows."""
    f = tmp_path / "a.log"
    f.write_text("a\nb\nlast")
    r = reader(tmp_path)
    p1 = r.latestOffset()
    assert [x[1:] for x in rows_of(r, {}, p1)] == [(0, 0, "a"), (0, 2, "b")]
    f.rename(tmp_path / "a.log.1")
    f.write_text("c\n")
    r = reader(tmp_path)  # restarted before p1 was committed
    p2 = r.latestOffset()
    assert [x[1:] for x in rows_of(r, p1, p2)] == [(0, 4, "last"), (1, 0, "c")]
    assert sorted(x[1:] for x in rows_of(r, {}, p2)) == [(0, 0, "a"), (0, 2, "b"), (0, 4, "last"), (1, 0, "c")]
    r.commit(p2)
    p3 = r.latestOffset()
    assert rows_of(r, p2, p3) == [] and len(p3[str(f)]) == 1  # finished epochs are forgotten once they are committed
    f.write_text("d\n" * 3)
    f.write_text("")
    p4 = r.latestOffset()
    with f.open("a") as h:
        h.write("e\n")
    p5 = r.latestOffset()
    assert [x[1:] for x in rows_of(r, p3, p4) + rows_of(r, p4, p5)] == [(2, 0, "e")]
    f.rename(tmp_path / "a.log.2")
    (tmp_path / "b.log").write_text("new\n")
    p6 = r.latestOffset()
    assert [x[3] for x in rows_of(r, p5, p6)] == ["new"]
    f.write_text("again\n")
    assert [x[1:] for x in rows_of(r, p6, r.latestOffset())] == [(3, 0, "again")]


def test_tail_in_ranges_through_rotation_loses_nothing(spark, tmp_path):
    """5,000 lines in small ranges over several tasks, a rotation between two batches, and a restart of the query."""
    folder = tmp_path / "in"
    folder.mkdir()
    lines, f = hdfs_lines(5000), folder / "a.log"
    f.write_text("\n".join(lines[:2500]) + "\n")
    c = config(tmp_path)
    for part in (None, lines[2500:]):
        if part:
            with f.open("a") as h:
                h.write("\n".join(part[:500]))
            f.rename(folder / "a.log.1")
            f.write_text("\n".join(part[500:]) + "\n")
        q = ingest.tail(spark, str(folder / "*.log"), c, read_bytes=120_000)
        try:
            assert ingest.drain(q, 120)
        finally:
            q.stop()
    got = store.current(spark, c.store)
    assert got.count() == 5000 == got.select("message").distinct().count()
    assert got.where("level = 'error'").count() == 100 and got.where("message LIKE '%blk_4242 %'").count() == 1
    assert got.where("epoch = 0").count() == 3000 and spark.read.parquet(c.dead_letters).count() == 0


def entries(spark, n, first=0):
    """n records and a rejected one."""
    rows = spark.range(first, first + n + 1).select(
        F.when(F.col("id") == first + n, "bad").otherwise(F.md5(F.col("id").cast("string"))).alias("id"), F.lit("s").alias("service"), F.current_timestamp().alias("timestamp"), F.current_timestamp().alias("observed_at"),
        F.lit("info").alias("level"), F.concat(F.lit("m"), "id").alias("message"), F.lit(None).cast("string").alias("host"), F.lit("a").alias("agent_id"), F.lit("/f").alias("source"), F.col("id").alias("offset"), F.lit(0).cast("bigint").alias("epoch"),
    )
    return rows


def seen(spark, c):
    dead = spark.read.parquet(c.dead_letters).count() if os.path.exists(c.dead_letters.removeprefix("file://")) else 0
    return store.read(spark, c.store).count(), dead


def test_failure_between_the_two_writes_shows_neither(spark, tmp_path, monkeypatch):
    c = config(tmp_path)
    ingest.prepare(spark, c)
    real = store.batch_rows

    def fails(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(store, "batch_rows", fails)
    with pytest.raises(RuntimeError):
        ingest.write_batch(spark, entries(spark, 10), 1, c)
    assert seen(spark, c) == (0, 0)
    monkeypatch.setattr(store, "batch_rows", real)
    ingest.write_batch(spark, entries(spark, 10), 1, c)
    ingest.write_batch(spark, entries(spark, 10), 1, c)
    assert seen(spark, c) == (10, 1)


@pytest.mark.parametrize("moves", [0, 1])
def test_failure_within_the_moves_is_made_good(spark, tmp_path, monkeypatch, moves):
    """The manifest decides: after a failure that comes behind it the next run carries it out, once."""
    c = config(tmp_path)
    ingest.prepare(spark, c)
    ingest.write_batch(spark, entries(spark, 5), 0, c)
    real, left = transaction.move, [moves]

    def move(*args):
        if not left[0]:
            raise RuntimeError("killed")
        left[0] -= 1
        real(*args)

    monkeypatch.setattr(transaction, "move", move)
    with pytest.raises(RuntimeError):
        ingest.write_batch(spark, entries(spark, 10, 100), 1, c)
    monkeypatch.setattr(transaction, "move", real)
    ingest.prepare(spark, c)
    assert seen(spark, c) == (15, 2) and transaction.recover(spark, c.store) == 0
    ingest.write_batch(spark, entries(spark, 10, 100), 1, c)  # the batch comes again, as its checkpoint did not move on
    assert seen(spark, c) == (15, 2)
    root = c.store.removeprefix("file://")
    assert not os.listdir(f"{root}/_staging") and not [x for x in os.listdir(f"{root}/_commits") if x.endswith(".json")]


def test_a_rewritten_batch_has_its_last_rows_only(spark, tmp_path):
    """Files of an earlier try go, on days too that the new one doesn't have; the index follows."""
    c = config(tmp_path)
    ingest.prepare(spark, c)
    ingest.write_batch(spark, entries(spark, 10).withColumn("timestamp", F.lit("2020-01-01").cast("timestamp")), 1, c)
    ingest.write_batch(spark, entries(spark, 4), 1, c)
    assert seen(spark, c) == (4, 1) and store.read(spark, c.store).where("timestamp < '2021-01-01'").count() == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.log").write_text("one\ntwo\n")
    for _ in range(2):
        ingest.load(spark, f"file://{tmp_path}/in", c)
    assert seen(spark, c)[0] == 6


def test_large_files_of_a_stream_are_read_in_blocks(spark, tmp_path):
    """Whatever their size, files give the same records."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "small.log").write_text("a\r\n\nb")
    (tmp_path / "in" / "large.log").write_text("\n".join(hdfs_lines(1500)) + "\n\n" + "x" * 70_000 + "\nend")
    got = []
    for whole in (0, 1000, 1 << 20):
        c = config(tmp_path / f"w{whole}", whole_bytes=whole)
        ingest.start(spark, f"file://{tmp_path}/in", c).awaitTermination()
        got.append(sorted((r.id, r.offset, r.message) for r in store.read(spark, c.store).collect()))
    assert got[0] == got[1] == got[2] and len(got[0]) == 2 + 1500 + 2 + 1
