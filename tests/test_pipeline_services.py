"""Spool, batches, the file log, and all services together: lines from a growing file to pages of a search."""

import json
import os
import random
import threading
import time
import urllib.error
import urllib.request
import zlib

import pytest

from timberline.functions.checksum import TABLE, crc32c
from timberline.operators import store
from timberline.service import __main__ as services
from timberline.service.agent import Agent, Batcher, http_session
from timberline.service.collector import Collector
from timberline.service.keys import KeyMap
from timberline.service.limiter import Limiters
from timberline.service.spool import FRAME, Spool, SpoolFull, whole_records
from timberline.sources import filelog
from timberline.streaming import ingest


def slow_crc(data):
    r = 0xFFFFFFFF
    for b in data:
        r ^= b
        for _ in range(8):
            r = r >> 1 ^ (0x82F63B78 if r & 1 else 0)
    return r ^ 0xFFFFFFFF


def test_crc32c():
    assert crc32c(b"123456789") == 0xE3069283 and crc32c(b"") == 0 and len(TABLE) == 256
    rng = random.Random(1)
    for n in (1, 1023, 1024, 1025, 2048, 5000, 9999):
        data = rng.randbytes(n)
        assert crc32c(data) == slow_crc(data) == crc32c(data[n // 3 :], crc32c(data[: n // 3]))


def test_spool_keeps_what_is_not_acknowledged(tmp_path):
    s = Spool(str(tmp_path / "s"), segment_bytes=100)
    ends = [s.append(bytes([i]) * 30) for i in range(10)]
    assert [r[0] for _, r in s.read()] == list(range(10)) and [p for p, _ in s.read()] == ends and len(s.sizes) > 3
    s.ack(ends[4])
    assert [r[0] for _, r in s.read()] == [5, 6, 7, 8, 9] and min(s.sizes) == ends[5][0]
    s.close()
    s = Spool(str(tmp_path / "s"), segment_bytes=100)
    assert s.acked == ends[4] and [r[0] for _, r in s.read()] == [5, 6, 7, 8, 9]
    s.ack(ends[9])
    assert not list(s.read()) and len(s.sizes) == 1
    s.append(b"new")
    assert [r for _, r in s.read()] == [b"new"]
    s.close()


def test_spool_cuts_a_torn_tail_and_a_damaged_record(tmp_path):
    folder = str(tmp_path / "s")
    s = Spool(folder)
    for i in range(3):
        s.append(b"record %d" % i)
    s.close()
    (name,) = [x for x in os.listdir(folder) if x.endswith(".seg")]
    with open(f"{folder}/{name}", "ab") as f:
        f.write(FRAME.pack(50, 1) + b"half")
    s = Spool(folder)
    assert [r for _, r in s.read()] == [b"record 0", b"record 1", b"record 2"]
    s.append(b"record 3")
    assert len(list(s.read())) == 4
    s.close()
    with open(f"{folder}/{name}", "rb") as f:
        data = bytearray(f.read())
    data[-1] ^= 1
    assert [len(whole_records(bytes(data))[0]), whole_records(b"")] == [3, ([], 0)]


def test_a_full_spool_refuses(tmp_path):
    s = Spool(str(tmp_path / "s"), segment_bytes=50, most_bytes=120)
    ends = [s.append(b"x" * 30) for _ in range(3)]
    with pytest.raises(SpoolFull):
        s.append(b"x" * 30)
    s.ack(ends[1])
    s.append(b"y" * 30)
    s.close()


def test_batches_are_due_by_count_size_and_time():
    now = [0.0]
    b = Batcher(3, 10, 0.2, lambda: now[0])
    assert b.add(b"1") is None and b.add(b"2") is None and b.add(b"3") == [b"1", b"2", b"3"]
    assert b.add(b"123456") is None and b.add(b"12345") == [b"123456"] and b.held == [b"12345"]
    now[0] = 0.1
    assert b.due() is None
    now[0] = 0.25
    assert b.due() == [b"12345"] and b.due() is None
    assert b.add(b"x" * 11) == [b"x" * 11]


def entry(i, **more):
    at = "2026-01-01T00:00:00+00:00"
    return json.dumps({"source": "/f", "offset": i, "message": f"m{i}", "observed_at": at, "timestamp": at, "level": "info", "agent_id": "a"} | more).encode()


def test_collector_answers_in_order_and_rejects_with_reasons():
    got, delays = [], random.Random(2)

    def send(records):
        time.sleep(delays.random() / 50)
        got.extend(records)

    taken = []

    def batches():
        for i in range(60):
            taken.append(i)
            yield b"\n".join([entry(10 * i + k) for k in range(i % 4 + 1)] + ([b"garbage", entry(7, message="")] if i == 5 else []))

    c, answers = Collector(send, in_flight=4), []
    for a in c.session("billing", batches()):
        answers.append(a)
        assert len(taken) - len(answers) <= 4
    assert [a["accepted"] for a in answers] == [i % 4 + 1 for i in range(60)]
    assert [r["reason"] for r in answers[5]["rejected"]] == ["unparseable", "empty message"] and not answers[4]["rejected"]
    assert len(got) == sum(i % 4 + 1 for i in range(60)) and {k for k, _ in got} == {"billing"} and json.loads(got[0][1])["service"] == "billing"


def test_file_log_offsets_start_and_lag(spark, tmp_path):
    folder = str(tmp_path / "log")
    p = filelog.Producer(folder, 3)
    p.send([("a", b"1"), ("b", b"2"), ("a", b"3")])
    assert filelog.Producer(folder, 3).next == p.next
    home = zlib.crc32(b"a") % 3
    assert p.send([("a", b"4")]) == {home: p.next[home] - 1}
    early, late = filelog.records(spark, folder), filelog.records(spark, folder, start="latest")
    p.send([("a", b"5"), ("c", b"6")])
    got = {}
    for name, df in (("early", early), ("late", late)):
        q = df.writeStream.format("memory").queryName(f"log_{name}").option("checkpointLocation", f"file://{tmp_path}/ck-{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        got[name] = spark.table(f"log_{name}").collect()
    assert sorted(bytes(r.value) for r in got["early"]) == [b"1", b"2", b"3", b"4", b"5", b"6"] and sorted(bytes(r.value) for r in got["late"]) == [b"5", b"6"]
    assert [bytes(r.value) for r in sorted(got["early"], key=lambda r: r.source_offset) if r.partition == home and bytes(r.value) in (b"1", b"3", b"4", b"5")] == [b"1", b"3", b"4", b"5"]
    assert filelog.lag(folder, {home: 1})[home] == p.next[home] - 1


def test_lines_travel_from_a_growing_file_to_a_search(spark, tmp_path):
    from tests.test_streaming import hdfs_lines
    from timberline.service.api import LogApi, serve

    log, files = str(tmp_path / "log"), tmp_path / "in"
    files.mkdir()
    lines, f = hdfs_lines(1500), files / "a.log"
    f.write_text("\n".join(lines[:700]) + "\n")
    keys = KeyMap.parse("k:hdfs")
    server = serve(LogApi(None, keys, collector=Collector(filelog.Producer(log).send)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_address[1]}/v1/ingest"
    spool = Spool(str(tmp_path / "spool"))
    agent, stop = Agent(str(files / "*.log"), spool, str(tmp_path / "registry"), batcher=Batcher(100)), threading.Event()
    agent.step()
    agent.send(http_session(url, "k"))
    agent = Agent(str(files / "*.log"), spool, str(tmp_path / "registry"), batcher=Batcher(100))  # started anew
    running = threading.Thread(target=agent.run, args=(http_session(url, "k"), stop))
    running.start()
    with f.open("a") as h:
        h.write("\n".join(lines[700:]) + "\n")
    time.sleep(1)
    stop.set()
    running.join(60)
    with pytest.raises(urllib.error.HTTPError):
        next(http_session(url, "wrong")([b"{}"]))
    server.shutdown()
    assert not list(spool.read()) and sum(filelog.ends(log).values()) == 1500
    filelog.Producer(log).send([("hdfs", b"garbage")])
    c = ingest.Config(f"file://{tmp_path}/store", f"file://{tmp_path}/dead", f"file://{tmp_path}/ck", "")
    q = ingest.index(spark, filelog.records(spark, log), c)
    assert ingest.drain(q, 180)
    got = store.current(spark, c.store)
    assert got.count() == 1500 == got.select("message").distinct().count() and got.where("level = 'error'").count() == 30 and got.where("service = 'hdfs'").count() == 1500
    assert got.where("timestamp >= '2008-11-09 20:00:00' AND timestamp < '2008-11-09 20:01:00'").count() == 180
    (dead,) = spark.read.parquet(c.dead_letters).collect()
    assert bytes(dead.value) == b"garbage" and dead.error == "unparseable: no record"
    api = LogApi(lambda: store.current(spark, c.store), keys, Limiters(100, 100))
    status, _, body = api.answer("/v1/logs?q=blk_142&limit=5", "k")
    assert status == 200 and [r["message"] for r in body["logs"]] == [lines[142]]


def test_entry_points(spark, tmp_path, capsys):
    assert services.main([]) == 2 and services.main(["agent"], {}) == 2
    said = capsys.readouterr().err
    assert "FILES is required" in said and "COLLECTOR is required" in said and len(services.COMMANDS) == 9
    (tmp_path / "in.txt").write_bytes(b"a\n\nb\r\nc\n")
    assert services.main(["loggen"], {"INPUT": str(tmp_path / "in.txt"), "OUTPUT": str(tmp_path / "out.log"), "COUNT": "7"}) == 0
    assert (tmp_path / "out.log").read_text().split() == list("abcabca")
    c = ingest.Config(f"file://{tmp_path}/store", f"file://{tmp_path}/dead", f"file://{tmp_path}/ck", "s")
    source = f"file://{tmp_path}/out.log"
    ingest.load(spark, source, c)
    name = store.current(spark, c.store).first().source
    env = {"STORE": c.store, "FILE": name, "REPORT": str(tmp_path / "report.json")}
    assert services.main(["zerolosscheck"], env) == 0
    with (tmp_path / "out.log").open("a") as f:
        f.write("more\n")
    assert services.main(["zerolosscheck"], env) == 1
    assert json.loads((tmp_path / "report.json").read_text())["missing"] == 1


def test_limiters_forget_full_buckets():
    limits = Limiters(1000, 2, most=3)
    for i in range(50):
        assert limits.allow(f"k{i}")[0]
        time.sleep(0.002)
    assert len(limits.buckets) <= 4
