"""Operators that split a hot group over tasks, against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from timberline.operators import alerts, percentiles, tail
from timberline.operators.tail import TailFilter


@pytest.mark.parametrize("interpolated", [False, True])
def test_grouped_percentiles_against_the_built_in_ones(spark, interpolated):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, *[round(rng.gauss(0, 9), 1)] * 9])) for _ in range(4000)] + [("one", 1.5), ("none", None), ("same", 2.0), ("same", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    points = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p999": 0.999, "p100": 1.0}
    how = "percentile_cont" if interpolated else "percentile_disc"
    want = df.where("v IS NOT NULL").groupBy("k").agg(*(F.expr(f"{how}({p}) WITHIN GROUP (ORDER BY v)").alias(n) for n, p in points.items()), F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
    got = percentiles.grouped(df, ["k"], "v", points, interpolated)
    rounded = lambda d: sorted((repr(r[0]), *(round(x, 9) for x in r[1:])) for r in d.collect())
    assert got.columns == want.columns and rounded(got) == rounded(want)
    assert percentiles.grouped(df.where("v > 1000"), ["k"], "v", points).count() == 0


def test_a_hot_group_is_many_tasks(spark):
    """Nearly all values are one group's; they lie in several ranges, and no task reads half of them."""
    df = spark.range(200_000).select(F.when(F.col("id") % 1000 == 0, "cold").otherwise("hot").alias("k"), (F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    got = percentiles.grouped(df, ["k"], "v", {"p50": 0.5}).collect()
    values = np.sort(np.array([i * 7919 % 100_003 for i in range(200_000) if i % 1000]))
    assert {r.k: r.p50 for r in got}["hot"] == values[-(-len(values) // 2) - 1]
    from timberline.operators.ranking import dealt

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # a table this small would be one range
    sizes = [r["count"] for r in dealt(df, [F.col("k"), F.col("v")]).groupBy(F.shiftright("__at", 33)).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 0.5 * sum(sizes)


def test_sketches_of_days_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("day"), (F.col("id") % 2).alias("k"), F.abs(F.hash("id") % 100_000).cast("double").alias("v"))
    days = percentiles.sketches(df, ["day", "k"], "v")
    got = percentiles.estimated(percentiles.merged(days, ["k"]), {"p50": 0.5, "p99": 0.99}).collect()
    for r in got:
        own = np.sort([x.v for x in df.where(F.col("k") == r.k).select("v").collect()])
        for name, p in (("p50", 0.5), ("p99", 0.99)):
            assert abs(np.searchsorted(own, r[name]) / len(own) - p) < 0.01


def folded(buckets, rule):
    """Transitions, bucket by bucket, of {service: {bucket: n}}."""
    newest, out = max((b for s in buckets.values() for b in s), default=0), []
    for service, n in buckets.items():
        on, ready = False, None
        for at in range(min(n), newest + 1):
            if not any(b in n for b in range(at - rule.window - rule.baseline + 1, at + 1)):
                continue
            win = sum(n.get(b, 0) for b in range(at - rule.window + 1, at + 1))
            usual = sum(n.get(b, 0) for b in range(at - rule.window - rule.baseline + 1, at - rule.window + 1)) * rule.window / rule.baseline
            if not on and win >= rule.min_errors and win >= rule.ratio * max(usual, 1) and (ready is None or at >= ready):
                on, ready = True, at + rule.cooldown
                out.append((service, at, "firing", win, round(usual, 6)))
            elif on and 2 * win < rule.min_errors:
                on = False
                out.append((service, at, "resolved", win, round(usual, 6)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_composed_chunks_equal_the_fold(spark, seed):
    """Short chunks, rules whose cooldown spans several, silences and a long-running spike."""
    rng = random.Random(seed)
    rule = alerts.Rule(window=rng.randint(1, 4), baseline=rng.randint(2, 8), min_errors=rng.randint(2, 6), ratio=1.5, cooldown=rng.choice([1, 5, 30]), bucket=1_000_000)
    data = {}
    for s in "abc":
        at, n = 0, {}
        for _ in range(60):
            at += rng.choice([1, 1, 1, 2, 5, 40])
            n[at] = rng.choice([1, 1, 2, 9, 30])
        data[s] = n
    data["long"] = {i: 50 for i in range(100, 103)} | {i: 500 for i in range(103, 160)}
    df = spark.createDataFrame([(s, b, n) for s, x in data.items() for b, n in x.items()], "service string, bucket long, n long")
    for chunk in (1, 17, 4096):
        got = sorted((r.service, r.bucket, r.kind, r.errors, round(r.usual, 6)) for r in alerts.transitions(df, rule, chunk).collect())
        assert got == folded(data, rule)
        assert alerts.windowed(df, rule, chunk).count() == alerts.ticks(df, rule).count()


def test_summaries_stand_for_any_state():
    """A summary of random ticks says what going through them does, from every state."""
    rng = random.Random(8)
    for _ in range(300):
        cooldown, start = rng.randint(0, 12), 100
        bucket = sorted(rng.sample(range(start, start + 40), rng.randint(1, 30)))
        kind = [rng.random() for _ in bucket]
        spike, calm = [k < 0.4 for k in kind], [k > 0.7 for k in kind]
        summary = alerts.Summary.of(bucket, spike, calm, start + cooldown, cooldown)
        for ready in (-(1 << 62), *range(start - 3, start + cooldown)):
            for first in (False, True):
                on, again = first, ready
                for b, s, c in zip(bucket, spike, calm):
                    if not on and s and b >= again:
                        on, again = True, b + cooldown
                    elif on and c:
                        on = False
                assert alerts.Summary.after(*summary, first, ready) == (on, again)


def subscriptions(rng, n):
    some = lambda values, p: tuple(rng.sample(values, rng.randint(1, 2))) if rng.random() < p else ()
    texts = ["", "", *[f"user={i} " for i in range(40)], "purchase", "er", "error", "é"]
    return {f"c{i}": TailFilter(some([f"svc-{k}" for k in range(6)], 0.7), some([f"host-{k}" for k in range(4)], 0.4), some(["error", "warn", "info"], 0.4), rng.choice(texts)) for i in range(n)}


def test_indexed_filters_equal_every_filter_on_every_event(spark):
    rng = random.Random(6)
    rows = [(i, f"svc-{i % 5}", rng.choice([None, "host-0", "host-1"]), rng.choice(["error", "warn", "info"]), rng.choice([None, "", f"PURCHASE user={i % 45} É", "Error er"])) for i in range(200)]
    logs = spark.createDataFrame(rows, "id long, service string, host string, level string, message string")
    own = subscriptions(rng, 300)
    want = sorted((c, r.id) for r in logs.collect() for c, f in own.items() if f({**r.asDict(), "message": r.message}))
    for indexed in (7, 200_000):
        got = tail.indexed_fan_out(logs, own, indexed)
        assert got.columns == [*logs.columns, "client"] and sorted((r.client, r.id) for r in got.collect()) == want
    few = dict(list(own.items())[:60])
    assert sorted((r.client, r.id) for r in tail.fan_out(logs, few).collect()) == [x for x in want if x[0] in few]
    assert tail.indexed_fan_out(logs, {}).count() == 0


def test_a_hundred_thousand_subscriptions(spark, sf_dir):
    """As many matches as a join of events and filters has."""
    from timberline.sources.tables import logs_from_events

    logs = logs_from_events(spark, sf_dir).select("id", "service", "host", "level", "message").limit(100)
    own = {f"c{i}": TailFilter((f"svc-{i % 700}",), (), ("error",) if i % 3 else (), f"user={i % 90} ") for i in range(100_000)}
    got = tail.fan_out(logs, own).groupBy("client").count()
    filters = spark.createDataFrame([(c, f.services[0], f.levels[0] if f.levels else None, f.text) for c, f in own.items()], "client string, s string, l string, t string")
    theta = logs.join(filters, (F.col("s") == F.col("service")) & (F.col("l").isNull() | (F.col("l") == F.col("level"))) & F.contains(F.lower("message"), F.col("t"))).groupBy("client").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, theta.collect())) and got.count() > 100


def test_audit_by_digests_compares_what_differs(spark):
    """Reports equal those by ids, with redelivered and unexpected ids; few ids are compared."""
    from timberline.operators import audit

    ids = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").alias("k"))
    at = F.timestamp_seconds(F.col("k"))
    expected = ids.where("k % 5 <> 1").select("id")
    stored = ids.where("k % 5 <> 1 AND k % 4001 <> 0").select("id", F.lit("/f").alias("source"), at.alias("observed_at"), at.alias("indexed_at"))
    again = stored.where("observed_at < '1970-01-01 00:10:00'").limit(3)
    other = ids.where("k = 1 OR k = 6").select("id", F.when(F.col("k") == 1, "/f").otherwise("/g").alias("source"), at.alias("observed_at"), at.alias("indexed_at"))
    for have in (stored, stored.unionByName(again), stored.unionByName(other), stored.where("false")):
        assert audit.report_by_digests(expected, have, "/f").collect() == audit.report(expected, have, "/f").collect()
        assert audit.report_by_digests(expected, have, "/f", (4,)).collect() == audit.report(expected, have, "/f").collect()
    few, there = audit.differing(expected, stored)
    assert few.count() <= 12 and there.count() <= 8
    assert [x.count() for x in audit.differing(expected, expected)] == [0, 0]


def test_epochs_over_chunks_equal_those_of_one_pass(spark):
    from timberline.operators import sequences

    rng, rows, want = random.Random(2), [], []
    for path in ("a", "b", None):
        epoch, size, inode = 0, 0, 1
        for t in sorted(rng.sample(range(3000), 400)):
            before = size, inode
            c = rng.random()
            size, inode = (rng.randint(0, size), inode) if c < 0.1 else (rng.randint(0, 9), inode + 1) if c < 0.15 else (size + rng.randint(0, 5), inode)
            epoch += (size < before[0] or inode != before[1]) and bool(rows) and rows[-1][0] == path
            rows.append((path, t, size, inode))
            want.append((path, t, epoch))
    rows, want = ([r for r in x if r[0] is not None] for x in (rows, want))
    df = spark.createDataFrame(rows, "p string, t long, s long, i long")
    for chunk in (1, 50, 100_000):
        got = sequences.epochs(df, "p", "t", "s", "i", chunk)
        assert got.columns == ["p", "t", "s", "i", "epoch"] and sorted((r.p, r.t, r.epoch) for r in got.collect()) == want
