import json

import pytest
from pyspark.sql import functions as F

from timberline.operators.bulk import deliver
from timberline.service.config import Settings
from timberline.service.report import write, zero_loss
from timberline.sources import containers, kafka, workload
from timberline.sources.prometheus import parse_samples, total
from timberline.sources.tables import logs_from_events


def test_container_metadata_and_selectors(spark, tmp_path):
    for cid, name, labels in (("a" * 20, "/payment", {"app": "demo"}), ("b" * 20, "/other", None)):
        d = tmp_path / cid
        d.mkdir()
        (d / "config.v2.json").write_text(json.dumps({"Name": name, "Config": {"Labels": labels}}, indent=1))
    meta = containers.metadata(spark, f"file://{tmp_path}/*/config.v2.json")
    assert sorted(r.name for r in meta.collect()) == ["other", "payment"]
    pick = lambda s: sorted(r.name for r in meta.where(containers.selected(F.col("labels"), s)).collect())
    assert pick("") == ["other", "payment"] and pick("app=demo") == ["payment"] and pick("app=x") == [] and pick("app") == ["other"]
    lines = spark.createDataFrame([(r.folder + "/json.log",) for r in meta.collect()] + [("/x/" + "c" * 20 + "/json.log",)], "source string")
    assert sorted(r.host for r in containers.named(lines, meta).collect()) == ["c" * 12, "other", "payment"]
    assert [r.host for r in containers.named(lines, meta, "app=demo").collect()] == ["payment"]


def test_kafka_needs_its_connector(spark):
    assert not kafka.available(spark)
    with pytest.raises(RuntimeError):
        kafka.records(spark, "h:1", "logs")
    progress = {"sources": [{"endOffset": {"logs": {"0": 5}}, "latestOffset": {"logs": {"0": 9, "1": 3}}}]}
    assert kafka.lag(progress) == {"logs-0": 4, "logs-1": 3}
    assert kafka.options("h:1", "t", "latest", 5)["maxOffsetsPerTrigger"] == "5"
    entry = spark.createDataFrame([("s", "m")], "service string, message string")
    assert tuple(kafka.producer(entry).first()) == ("s", '{"service":"s","message":"m"}')


def test_bulk_resends_only_what_may_succeed():
    calls, answers = [], [[429, 201, 400, 503], [200, 201]]

    def send(items):
        calls.append(list(items))
        return answers[len(calls) - 1]

    assert deliver([0, 1, 2, 3], send, sleep=lambda _: None) == [(2, 400)]
    assert calls == [[0, 1, 2, 3], [0, 3]]
    with pytest.raises(OSError):
        deliver([1], lambda _: [], attempts=3, sleep=lambda _: None)


def test_settings():
    s = Settings({"A": "1", "D": "1m30s", "L": "a, b,", "X": "y"})
    assert (s.integer("A"), s.seconds("D"), s.items("L"), s.text("N", "z")) == (1, 90.0, ["a", "b"], "z")
    s.integer("X", 0), s.text("MISSING"), s.seconds("A", 1.0)
    with pytest.raises(ValueError) as e:
        s.check()
    assert str(e.value) == "X is no whole number; MISSING is required; A is no duration"


def test_report_and_exit_status(spark, sf_dir, tmp_path):
    logs = logs_from_events(spark, sf_dir)
    out = zero_loss(logs, logs, "/var/log/events.log")
    assert write(out, str(tmp_path / "r.json")) == 0 and json.loads((tmp_path / "r.json").read_text())["missing"] == 0
    assert zero_loss(logs, logs.where("offset > 3"), "/var/log/events.log")["zero_loss"] is False


def test_metric_texts(spark):
    lines = ['# HELP x', 'x_total{a="1",b="q\\"z"} 3', 'x_total{a="2"} 4.5', "up 1", "bad line here now", "y +Inf"]
    s = parse_samples(spark.createDataFrame([(x,) for x in lines], "value string")).cache()
    assert total(s, "x_total") == 7.5 and total(s, "x_total", a="2") == 4.5 and s.count() == 4
    with pytest.raises(LookupError):
        total(s, "x_total", a="9")


def test_workload(spark):
    one = workload.targets(50, 7, 1_700_000_000, 1_700_100_000, ["error"], ["blk_1"])
    assert one == workload.targets(50, 7, 1_700_000_000, 1_700_100_000, ["error"], ["blk_1"]) and len(set(one)) > 20
    got = workload.run(lambda t: (200, "HIT", 0), one, 2, 0.02, 0.1)
    assert got["requests"] == got["statuses"][200] == got["hits"] == got["empty"] and got["max"] >= got["p50"]
    logs = spark.createDataFrame([("x blk_2 y", 5), ("blk_-1", 1), ("blk_2", 0), ("none", 2)], "message string, offset long")
    assert workload.block_ids(logs) == ["blk_2", "blk_-1"]


def test_paced_lines_loop_in_order(spark, tmp_path):
    import time

    from timberline.sources.generators import paced

    lines = spark.createDataFrame([(i, f"line {i}") for i in range(7)], "i long, line string")
    q = paced(spark, lines, 20).writeStream.format("memory").queryName("paced_out").option("checkpointLocation", f"file://{tmp_path}/ck").start()
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("paced_out").count() < 30:
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.table("paced_out").orderBy("value").collect()
    assert len(got) >= 30 and [r.line for r in got] == [f"line {r.value % 7}" for r in got] and [r.value for r in got] == list(range(len(got)))
