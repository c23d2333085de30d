import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from timberline.operators import alerts, bench, metrics, search, sequences, store, tail, validate
from timberline.sources.tables import logs_from_events
from timberline.streaming.alerting import Detector

ID = "0" * 32


def test_validation_order(spark):
    now = dt.datetime(2026, 1, 1)
    base = dict(id=ID, message="x", timestamp=now, observed_at=now, level="info", source="/f")
    cases = [
        ({}, None), ({"timestamp": dt.datetime(2008, 1, 1)}, None), ({"id": "nope"}, "invalid id"), ({"message": ""}, "empty message"),
        ({"message": "x" * 65537}, "message too large"), ({"timestamp": None}, "missing or invalid timestamp"),
        ({"timestamp": now + dt.timedelta(hours=25)}, "timestamp too far in the future"), ({"observed_at": None}, "missing or invalid observed_at"),
        ({"level": "99"}, "unknown level"), ({"source": None}, "missing source"), ({"id": None, "source": None}, "invalid id"),
    ]
    rows = [tuple((base | c).values()) for c, _ in cases]
    df = spark.createDataFrame(rows, "id string, message string, timestamp timestamp, observed_at timestamp, level string, source string")
    got = [r[0] for r in df.select(validate.reason(F.lit("2026-01-01").cast("timestamp"))).collect()]
    assert got == [w for _, w in cases]


def test_route_stamps_service(spark):
    df = spark.createDataFrame([(ID, "x"), (ID, "")], "id string, message string").select(
        "*", F.lit("claimed").alias("service"), F.current_timestamp().alias("timestamp"), F.current_timestamp().alias("observed_at"), F.lit("info").alias("level"), F.lit("/f").alias("source")
    )
    good, bad = validate.route(df, F.current_timestamp(), F.lit("billing"))
    assert [r.service for r in good.collect()] == ["billing"] and [r.reason for r in bad.collect()] == ["empty message"]


@pytest.mark.parametrize(
    "params,field",
    [({"level": "loud"}, "level"), ({"from": "yesterday"}, "from"), ({"from": "2026-01-02T00:00:00Z", "to": "2026-01-01T00:00:00Z"}, "from"), ({"limit": "0"}, "limit"), ({"limit": "1001"}, "limit"), ({"cursor": "!!!"}, "cursor"), ({"q": "é" * 300}, "q"), ({"service": "x" * 129}, "service")],
)
def test_bad_parameters(params, field):
    with pytest.raises(search.InvalidArgument) as e:
        search.parse_query(params)
    assert e.value.field == field


def test_walk_visits_every_row_once_in_order(spark, sf_dir):
    logs = logs_from_events(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp")).cache()
    query, seen = search.Query(limit=300), []
    while True:
        rows, after = search.fetch(logs, query)
        seen += [(r["_ms"], r["id"]) for r in rows]
        if after is None:
            break
        query = search.Query(limit=300, after=after)
    assert len(seen) == logs.count() == len(set(seen)) and seen == sorted(seen, reverse=True)


def test_search_pushes_filters_and_prunes_days(spark, sf_dir, tmp_path):
    path = f"file://{tmp_path}/logs"
    logs_from_events(spark, sf_dir).select("id", "service", "timestamp", "observed_at", "indexed_at", "level", "message", "host", "agent_id", "source", "offset", "epoch", "event_date").write.partitionBy("event_date").parquet(path)
    q = search.Query(service="svc-1", start=dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc), end=dt.datetime(2024, 1, 7, tzinfo=dt.timezone.utc))
    df = search.page(store.read(spark, path), q)
    plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "TakeOrderedAndProject" in plan and "EqualTo(service,svc-1)" in plan and "event_date" in plan.split("PartitionFilters")[1][:200]
    assert df.count() == logs_from_events(spark, sf_dir).where("service = 'svc-1' AND timestamp >= '2024-01-05' AND timestamp < '2024-01-07'").limit(100).count()


def test_upsert_is_idempotent_and_keeps_last_write(spark, sf_dir, tmp_path):
    path = f"file://{tmp_path}/s"
    store.create(spark, path)
    columns = store.read(spark, path).columns
    batch = logs_from_events(spark, sf_dir).select(*columns).limit(300)
    store.upsert(spark, path, batch, 0)
    store.upsert(spark, path, batch, 1)
    newer = batch.limit(10).withColumns({"level": F.lit("fatal"), "indexed_at": F.col("indexed_at") + F.expr("INTERVAL '1' DAY")})
    store.upsert(spark, path, newer.unionByName(batch.limit(10)), 2)
    got = store.read(spark, path)
    assert got.count() == 300 == got.select("id").distinct().count() and got.where("level = 'fatal'").count() == newer.count()


@pytest.mark.parametrize("aqe", ["true", "false"])
@pytest.mark.parametrize("partitions", ["64", "200"])
def test_ranking_keeps_every_row_of_wide_and_uneven_tables(spark, aqe, partitions):
    from timberline.operators.ranking import ranked, running

    names = {"spark.sql.adaptive.enabled": aqe, "spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        n = 20_000
        rows = spark.range(n, numPartitions=8).select("id", F.xxhash64("id").alias("k"), F.repeat(F.lit("x"), (F.col("id") % 97 * F.col("id") % 311).cast("int")).alias("wide"), (F.col("id") % 3).alias("n"))
        got = ranked(rows, [F.col("k").desc()])
        assert got.columns == [*rows.columns, "place"]
        keys = sorted((r.k for r in rows.select("k").collect()), reverse=True)
        out = got.orderBy("place").collect()
        assert [r.place for r in out] == list(range(1, n + 1)) and [r.k for r in out] == keys
        total, want = 0, {}
        for r in rows.orderBy("k").select("k", "n").collect():
            want[r.k] = total
            total += r.n
        assert {r.k: r.before for r in running(rows.select("k", "n"), [F.col("k")], "n", "before").collect()} == want
        assert ranked(rows.where("id < 0"), [F.col("k")]).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_stray_time_makes_few_ticks(spark):
    rule = alerts.Rule()
    df = spark.createDataFrame([("s", 1, 9), ("s", 2_000_000_000, 9), ("t", 5, 1)], "service string, bucket long, n long")
    assert alerts.ticks(df, rule).count() == 2 * (rule.window + rule.baseline) + 1
    assert [(r.bucket, r.kind) for r in alerts.transitions(df, rule).orderBy("bucket").collect()] == [(1, "firing"), (1 + rule.window, "resolved"), (2_000_000_000, "firing")]


def test_batches_compaction_and_redelivery(spark, sf_dir, tmp_path):
    path = f"file://{tmp_path}/s"
    store.create(spark, path)
    columns = store.read(spark, path).columns
    rows = logs_from_events(spark, sf_dir).select(*columns)
    for i in range(3):
        store.append(spark, path, rows.where(F.col("offset") % 3 == i), i)
    store.append(spark, path, rows.where(F.col("offset") % 3 == 1), 1)
    assert store.read(spark, path).count() == rows.count()
    day = rows.agg(F.min("event_date")).first()[0]
    assert store.compact(spark, path, day) == 3 and store.compact(spark, path, day) == 1
    store.append(spark, path, rows.where(F.col("offset") % 2 == 0), "again")
    assert store.compact(spark, path, day) == 2 and store.compact(spark, path, "1999-01-01") == 0
    assert store.current(spark, path).select("id").count() == rows.count()


def test_counter_increases_over_chunks(spark):
    from timberline.operators import metrics

    data = [("a", t, v) for t, v in [(0, 5), (10, 9), (50, 12), (51, 3), (200, 4), (1000, 4), (1001, 1)]]
    df = spark.createDataFrame(data, "h string, t long, v long")
    for chunk in (20, 100, 86_400):
        assert [r._up for r in metrics.increases(df, ["h"], "t", "v", chunk=chunk).orderBy("t").collect()] == [0, 4, 3, 3, 1, 0, 1]
    got = metrics.rate_of(df.withColumn("u", F.lit(1)), ["h"], "t", "u", 25, 10).orderBy("tick").collect()
    want = {}
    for _, t, _ in data:
        for tick in range(-(-t // 10) * 10, t + 25, 10):
            want[tick] = want.get(tick, 0) + 1
    assert {r.tick: round(r.rate * 25) for r in got} == want


def test_alert_golden_count(spark):
    b = alerts.error_buckets(logs_from_events(spark, "/root/testdata/sf0.01"), alerts.Rule())
    kinds = [r.kind for r in alerts.transitions(b, alerts.Rule()).collect()]
    assert (kinds.count("firing"), kinds.count("resolved")) == (118, 117)


def test_batch_and_live_detector_agree(spark):
    rng, rule = random.Random(4), alerts.Rule(window=3, baseline=12, min_errors=4, ratio=2.0, cooldown=5)
    counts = {b: rng.choice([0, 0, 0, 1, 2, 9]) for b in range(200)}
    counts[0] = counts[199] = 1
    live, want = Detector(rule), []
    for b in range(200):
        if counts[b]:
            live.observe(b, counts[b])
        if (got := live.evaluate(b)) is not None:
            want.append((b, *got))
    df = spark.createDataFrame([("s", b, n) for b, n in counts.items() if n], "service string, bucket long, n long")
    assert [(r.bucket, r.kind, r.errors, r.usual) for r in alerts.transitions(df, rule).orderBy("bucket").collect()] == want


def test_detector_scenarios():
    rule = alerts.Rule(window=10, baseline=60, min_errors=10, ratio=5, cooldown=30)
    d = Detector(rule)
    d.observe(60, 6)
    fired = []
    for t in range(60, 65):
        d.observe(t, 3)
        if (x := d.evaluate(t)) is not None:
            fired.append((t, x))
    assert len(fired) == 1 and fired[0][1][0] == "firing" and fired[0][1][2] == 0
    quiet = [x for t in range(65, 80) if (x := d.evaluate(t)) is not None]
    assert [x[0] for x in quiet] == ["resolved"]
    d.observe(76, 50)
    assert d.evaluate(76) is None  # cooldown
    few = Detector(rule)
    few.observe(5, 9)
    assert few.evaluate(5) is None
    old = Detector(rule)
    old.observe(1, 99, now=5000)
    old.observe(9999, 20, now=5000)
    assert old.counts == {5000: 20}
    assert old.evaluate(5000)[0] == "firing" and not old.idle


def test_tail_filter():
    f = tail.TailFilter.parse("hdfs, apache", "h1", "WARN,error", " Timeout ")
    e = dict(service="hdfs", level="error", host="h1", message="Connection TIMEOUT after 5s")
    assert f(e) and not f(e | {"service": "nginx"}) and not f(e | {"level": "info"}) and not f(e | {"message": "all good"}) and not f(e | {"host": "h2"})
    assert tail.TailFilter.parse()(e)
    with pytest.raises(ValueError):
        tail.TailFilter.parse(level="loud")


def test_histogram_quantile_edges(spark):
    h = spark.createDataFrame([("a", 1.0, 0), ("a", 2.0, 10), ("a", float("inf"), 10), ("b", 1.0, 0), ("b", float("inf"), 5), ("c", 1.0, 0), ("c", float("inf"), 0)], "k string, bound double, count long")
    got = {r.k: r.value for r in metrics.histogram_quantile(h, ["k"], 0.5).collect()}
    assert got["a"] == 1.5 and got["b"] == 1.0 and got["c"] != got["c"]


def test_counter_rate_restarts(spark):
    s = spark.createDataFrame([("x", 0, 5), ("x", 10, 9), ("x", 20, 2)], "k string, at long, v long")
    got = {r.tick: r.rate for r in metrics.counter_rate(s, ["k"], "at", "v", 60, 30).collect()}
    assert got[30] == pytest.approx(6 / 60)


def test_percentiles_and_rank_test(spark):
    df = spark.range(1, 101).withColumn("v", F.col("id").cast("double"))
    assert df.agg(*(bench.nearest_rank("v", p) for p in (50, 90, 99, 100))).first()[0:4] == (50, 90, 99, 100)
    assert bench.mann_whitney_p([1, 2, 3, 4, 5], [6, 7, 8, 9, 10]) == pytest.approx(2 / 252)
    assert bench.mann_whitney_p(list(range(30)), list(range(30))) == pytest.approx(1.0)
    assert sorted(x for w in range(3) for x in bench.strided(10, 3, w, 0)) == list(range(10))


def test_sequences(spark):
    acks = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, False), ("c", 1, True), ("c", 2, True)], "k string, s int, ok boolean")
    assert {r.k: r.cursor for r in sequences.contiguous_prefix(acks, ["k"], "s", "ok").collect()} == {"a": 1, "b": None, "c": 2}
    files = spark.createDataFrame([("p", 1, 10, 7), ("p", 2, 20, 7), ("p", 3, 5, 7), ("p", 4, 9, 8)], "p string, t int, size long, inode long")
    assert [r.epoch for r in sequences.epochs(files, "p", "t", "size", "inode").orderBy("t").collect()] == [0, 0, 1, 2]
    calls = spark.createDataFrame([("k", i, 0) for i in range(6)] + [("k", 6, 100)], "k string, i long, t long")
    got = sequences.token_bucket(calls, "k", "i", "t", 10, 5).orderBy("i").collect()
    assert [r.allowed for r in got] == [True] * 5 + [False, True] and got[5].wait_ms == 100
