"""Queries on alerts, live tail, metrics and benchmark statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from timberline.operators import alerts, bench, metrics, percentiles, reports, sequences
from timberline.operators.tail import TailFilter, buffered, events, fan_out, kept
from timberline.plans.registry import query, with_logs
from timberline.sources.tables import logs_from_events, table

RULE = alerts.Rule()

BUCKETS = """b AS (SELECT service, epoch_us(observed_at) // 3600000000 AS bucket, count(*) AS n FROM logs WHERE level IN ('error', 'fatal') GROUP BY 1, 2)"""
WINDOWS = """
lim AS (SELECT min(bucket) AS lo, max(bucket) AS hi FROM b),
sp AS (SELECT service, unnest(range(lo, hi + 1)) AS bucket FROM (SELECT DISTINCT service FROM b), lim),
w AS (SELECT sp.service, sp.bucket,
        sum(coalesce(n, 0)) OVER (PARTITION BY sp.service ORDER BY sp.bucket RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)::BIGINT AS win,
        coalesce(sum(coalesce(n, 0)) OVER (PARTITION BY sp.service ORDER BY sp.bucket RANGE BETWEEN 53 PRECEDING AND 6 PRECEDING), 0) * 6 / 48.0::DOUBLE AS usual
      FROM sp LEFT JOIN b ON sp.service = b.service AND sp.bucket = b.bucket)"""


@query("error_buckets", with_logs("SELECT service, bucket, n FROM b", BUCKETS))
def error_buckets(spark, d):
    return alerts.error_buckets(logs_from_events(spark, d), RULE)


@query("window_baseline", with_logs("SELECT service, bucket, win, usual FROM w WHERE win > 0 OR usual > 0", BUCKETS, WINDOWS.strip()))
def window_baseline(spark, d):
    return alerts.windowed(alerts.error_buckets(logs_from_events(spark, d), RULE), RULE)


@query("spike_candidates", with_logs("SELECT service, bucket, win, usual FROM w WHERE win >= 5 AND win >= 1.5 * greatest(usual, 1)", BUCKETS, WINDOWS.strip()))
def spike_candidates(spark, d):
    return alerts.windowed(alerts.error_buckets(logs_from_events(spark, d), RULE), RULE).where(alerts.spiking(RULE))


@query(
    "alert_transitions",
    with_logs(
        """SELECT service, bucket, kind, win AS errors, usual FROM st WHERE kind IS NOT NULL""",
        BUCKETS,
        WINDOWS.strip(),
        """r AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY bucket) AS rn FROM w),
st AS (
  SELECT service, bucket, win, usual, rn, win >= 5 AND win >= 1.5 * greatest(usual, 1) AS firing,
         CASE WHEN win >= 5 AND win >= 1.5 * greatest(usual, 1) THEN bucket END AS last, CASE WHEN win >= 5 AND win >= 1.5 * greatest(usual, 1) THEN 'firing' END AS kind
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.service, r.bucket, r.win, r.usual, r.rn,
         CASE WHEN s.firing THEN NOT (2 * r.win < 5) ELSE r.win >= 5 AND r.win >= 1.5 * greatest(r.usual, 1) AND (s.last IS NULL OR r.bucket - s.last >= 12) END,
         CASE WHEN NOT s.firing AND r.win >= 5 AND r.win >= 1.5 * greatest(r.usual, 1) AND (s.last IS NULL OR r.bucket - s.last >= 12) THEN r.bucket ELSE s.last END,
         CASE WHEN NOT s.firing AND r.win >= 5 AND r.win >= 1.5 * greatest(r.usual, 1) AND (s.last IS NULL OR r.bucket - s.last >= 12) THEN 'firing' WHEN s.firing AND 2 * r.win < 5 THEN 'resolved' END
  FROM st s JOIN r ON r.service = s.service AND r.rn = s.rn + 1)""",
    ).replace("WITH logs", "WITH RECURSIVE logs", 1),
)
def alert_transitions(spark, d):
    return alerts.transitions(alerts.error_buckets(logs_from_events(spark, d), RULE), RULE)


@query(
    "alert_samples",
    with_logs("""SELECT service, rank, message FROM (SELECT service, message, row_number() OVER (PARTITION BY service ORDER BY observed_at DESC, id DESC)::INTEGER AS rank FROM logs WHERE level IN ('error', 'fatal')) WHERE rank <= 3"""),
)
def alert_samples(spark, d):
    return alerts.samples(logs_from_events(spark, d), RULE)


@query(
    "slack_text",
    with_logs(
        """SELECT w.service, w.bucket, format(':rotating_light: *Error spike in `{}`*' || chr(10) || '{} errors in the last 6h0m0s (usually about {:.0f}).', w.service, win, usual) || chr(10) || 'Most recent:' || texts AS text
        FROM w JOIN (SELECT service, string_agg(chr(10) || '• `' || replace(replace(replace(replace(message, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '`', chr(39)) || '`', '' ORDER BY rank) AS texts FROM s GROUP BY service) USING (service)
        WHERE win >= 5 AND win >= 1.5 * greatest(usual, 1)""",
        BUCKETS, WINDOWS.strip(),
        """s AS (SELECT * FROM (SELECT service, message, row_number() OVER (PARTITION BY service ORDER BY observed_at DESC, id DESC) AS rank FROM logs WHERE level IN ('error', 'fatal')) WHERE rank <= 3)""",
    ),
)
def slack_text(spark, d):
    """The notifier's own text of every spike, with the samples of its service."""
    from timberline.service.notify import rendered

    logs = logs_from_events(spark, d)
    spikes = alerts.windowed(alerts.error_buckets(logs, RULE), RULE).where(alerts.spiking(RULE))
    texts = alerts.samples(logs, RULE).groupBy("service").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "message"))), lambda x: x["message"]).alias("samples"))
    rows = spikes.join(texts, "service").select("service", "bucket", F.lit("firing").alias("kind"), F.col("win").alias("errors"), "usual", "samples")
    return rendered(rows, RULE.window * RULE.bucket / 1e6).select("service", "bucket", "text")


@query("tail_filter", with_logs("""SELECT id, service, level, host FROM logs WHERE service IN ('svc-1', 'svc-2') AND level IN ('warn', 'error') AND contains(lower(message), 'user=1')"""))
def tail_filter(spark, d):
    f = TailFilter.parse(service="svc-1, svc-2", level="WARN,error", q=" User=1 ")
    return events(logs_from_events(spark, d)).where(f.column()).select("id", "service", "level", "host")


CLIENTS = {"a": TailFilter.parse(service="svc-0"), "b": TailFilter.parse(level="error", host="host-1"), "c": TailFilter.parse(q="purchase"), "d": TailFilter.parse()}
BUFFERS = {"a": 100, "b": 5000, "c": 7, "d": 1000}
FAN = """fan AS (SELECT id, unnest(list_filter([CASE WHEN service = 'svc-0' THEN 'a' END, CASE WHEN level = 'error' AND host = 'host-1' THEN 'b' END, CASE WHEN contains(lower(message), 'purchase') THEN 'c' END, 'd'], lambda x: x IS NOT NULL)) AS client FROM logs)"""


@query("tail_fanout", with_logs("SELECT client, id FROM fan", FAN))
def tail_fanout(spark, d):
    return fan_out(logs_from_events(spark, d), CLIENTS).select("client", "id")


@query("tail_buffer_drop", with_logs("""SELECT client, least(n, s)::BIGINT AS delivered, (n - least(n, s))::BIGINT AS dropped FROM (SELECT client, count(*) AS n, CASE client WHEN 'a' THEN 100 WHEN 'b' THEN 5000 WHEN 'c' THEN 7 ELSE 1000 END AS s FROM fan GROUP BY client)""", FAN))
def tail_buffer_drop(spark, d):
    return buffered(fan_out(logs_from_events(spark, d), CLIENTS), BUFFERS)


@query("tail_buffer_kept", with_logs("""SELECT client, id FROM (SELECT client, id, row_number() OVER (PARTITION BY client ORDER BY "timestamp", id) AS r, CASE client WHEN 'a' THEN 100 WHEN 'b' THEN 5000 WHEN 'c' THEN 7 ELSE 1000 END AS s FROM fan JOIN logs USING (id)) WHERE r <= s""", FAN))
def tail_buffer_kept(spark, d):
    """Which events of a burst the buffers take."""
    matches = fan_out(logs_from_events(spark, d).select("id", "service", "timestamp", "level", "message", "host"), CLIENTS)
    return kept(matches, BUFFERS, ["timestamp", "id"]).select("client", "id")


BOUNDS = metrics.exponential_bounds(1.0, 2.0, 10)
HIST = "h AS (SELECT event_type, count_if(value <= b)::BIGINT AS count, b AS bound FROM events, (SELECT unnest([1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 256.0, 512.0, 'Infinity'::DOUBLE]) AS b) GROUP BY event_type, b)"


@query("histogram_cumulative", f"WITH {HIST} SELECT event_type, CASE WHEN isinf(bound) THEN '+Inf' ELSE bound::INTEGER::VARCHAR END AS le, count FROM h")
def histogram_cumulative(spark, d):
    h = metrics.cumulative_histogram(table(spark, d, "events"), ["event_type"], "value", BOUNDS)
    return h.select("event_type", F.when(F.col("bound") == float("inf"), "+Inf").otherwise(F.col("bound").cast("int").cast("string")).alias("le"), "count")


@query(
    "histogram_quantile",
    f"""WITH {HIST}, l AS (SELECT *, lag(bound, 1, 0.0) OVER o AS b0, lag(count, 1, 0) OVER o AS c0, max(count) OVER (PARTITION BY event_type) AS total FROM h WINDOW o AS (PARTITION BY event_type ORDER BY bound))
    SELECT event_type, round(CASE WHEN isinf(bound) THEN b0 ELSE b0 + (bound - b0) * (0.9 * total - c0) / (count - c0) END, 6) AS p90 FROM l WHERE count >= 0.9 * total AND c0 < 0.9 * total""",
)
def histogram_quantile(spark, d):
    h = metrics.cumulative_histogram(table(spark, d, "events"), ["event_type"], "value", BOUNDS)
    return metrics.histogram_quantile(h, ["event_type"], 0.9).select("event_type", F.round("value", 6).alias("p90"))


COUNTER = """c AS (SELECT 'host-' || (user_id % 3) AS host, epoch_us(ts) // 1000000 AS at_s, event_id, (row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) % 100)::BIGINT AS value FROM events)"""
RATE = f"""WITH {COUNTER},
u AS (SELECT host, at_s, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS up FROM (SELECT *, lag(value) OVER (PARTITION BY host ORDER BY at_s, event_id) AS p FROM c)),
t AS (SELECT host, up, at_s, unnest(range(((at_s + 299) // 300) * 300, ((at_s + 299) // 300) * 300 + 3600, 300)) AS tick FROM u)"""


def counter(spark, d):
    e = table(spark, d, "events")
    of = Window.partitionBy(F.col("user_id") % 3).orderBy("ts", "event_id")
    return e.select(
        F.concat(F.lit("host-"), F.col("user_id") % 3).alias("host"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("bigint").alias("at_s"),
        "event_id", (F.row_number().over(of) % 100).cast("bigint").alias("value"),
    )


@query("counter_rate", RATE + " SELECT host, tick, round(sum(up) / 3600.0, 9) AS rate FROM t WHERE tick - at_s < 3600 GROUP BY host, tick")
def counter_rate(spark, d):
    rates = metrics.counter_rate(counter(spark, d), ["host"], "at_s", "value", 3600, 300, ties=["event_id"])
    return rates.select("host", "tick", F.round("rate", 9).alias("rate"))


@query("sum_by_label", with_logs("SELECT service, level, round(sum(value), 4) AS total FROM logs GROUP BY service, level"))
def sum_by_label(spark, d):
    return metrics.sum_by(logs_from_events(spark, d), ["service", "level"], "value").withColumn("total", F.round("total", 4))


SNAP = """a AS (SELECT level, count(*) AS n FROM logs GROUP BY level), z AS (SELECT level, count(*) AS n FROM logs WHERE "offset" < 500 AND level <> 'debug' GROUP BY level)"""


@query("stage_delta", with_logs("SELECT a.level, (a.n - coalesce(z.n, 0))::BIGINT AS delta FROM a LEFT JOIN z USING (level)", SNAP))
def stage_delta(spark, d):
    logs = logs_from_events(spark, d)
    count = lambda x: x.groupBy("level").agg(F.count("*").alias("n"))
    return metrics.snapshot_delta(count(logs), count(logs.where("offset < 500 AND level <> 'debug'")), ["level"], "n")


@query("stage_latencies", with_logs("""SELECT service, round(avg(greatest((epoch_us(observed_at) - epoch_us("timestamp")) / 1000.0, 0)), 6) AS read_ms, round(avg(greatest((epoch_us(indexed_at) - epoch_us(observed_at)) / 1000.0, 0)), 6) AS index_ms FROM logs GROUP BY service"""))
def stage_latencies(spark, d):
    dwell = lambda a, b: F.round(F.avg(metrics.clamped_ms(F.col(a), F.col(b))), 6)
    return logs_from_events(spark, d).groupBy("service").agg(dwell("observed_at", "timestamp").alias("read_ms"), dwell("indexed_at", "observed_at").alias("index_ms"))


@query("nearest_rank_percentiles", "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY event_type")
def nearest_rank_percentiles(spark, d):
    points = {f"p{p}": p / 100 for p in (50, 90, 99)}
    return percentiles.grouped(table(spark, d, "events"), ["event_type"], "value", points).select("event_type", *points)


STATUS = "r AS (SELECT o_orderkey, [200, 200, 200, 429, 503][(o_orderkey % 5) + 1] AS status, o_orderkey % 3 = 0 AS hit, o_totalprice / 1000 AS ms FROM orders)"


def requests(spark, d):
    status = F.element_at(F.array(*map(F.lit, (200, 200, 200, 429, 503))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"), (F.col("o_orderkey") % 3 == 0).alias("hit"), (F.col("o_totalprice") / 1000).alias("ms"))


@query("status_count_map", f"WITH {STATUS} SELECT string_agg(status || ':' || n, ',' ORDER BY status) AS counts, sum(n)::BIGINT AS requests FROM (SELECT status, count(*) AS n FROM r GROUP BY status)")
def status_count_map(spark, d):
    return reports.status_counts(requests(spark, d), "status")


@query("hit_miss_percentiles", f"WITH {STATUS} SELECT quantile_disc(ms, 0.5) FILTER (hit) AS hit_p50, quantile_disc(ms, 0.99) FILTER (hit) AS hit_p99, quantile_disc(ms, 0.5) FILTER (NOT hit) AS miss_p50, quantile_disc(ms, 0.99) FILTER (NOT hit) AS miss_p99, count_if(hit)::BIGINT AS hits FROM r")
def hit_miss_percentiles(spark, d):
    return reports.hit_miss(requests(spark, d), "ms", "hit", {"p50": 0.5, "p99": 0.99})


@query("warmup_filter", f"WITH {STATUS} SELECT o_orderkey, ms FROM r WHERE o_orderkey >= 1000")
def warmup_filter(spark, d):
    return reports.after_warmup(requests(spark, d), "o_orderkey", 1000).select("o_orderkey", "ms")


@query("bench_median_range", "SELECT o_orderpriority AS variant, median(o_totalprice) AS median, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS runs FROM orders GROUP BY 1")
def bench_median_range(spark, d):
    return bench.summary(table(spark, d, "orders").withColumnRenamed("o_orderpriority", "variant"), ["variant"], "o_totalprice")


@query("cpu_mean_peak", "SELECT o_orderstatus AS container, round(avg(o_totalprice), 4) AS mean, max(o_totalprice) AS peak FROM orders GROUP BY 1")
def cpu_mean_peak(spark, d):
    readings = table(spark, d, "orders").withColumnRenamed("o_orderstatus", "container")
    return reports.mean_peak(readings, "container", "o_totalprice").withColumn("mean", F.round("mean", 4))


@query(
    "mann_whitney_u",
    """WITH x AS (SELECT event_type, value FROM events WHERE event_type IN ('click', 'view')),
    k AS (SELECT event_type, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS r FROM x),
    s AS (SELECT count_if(event_type = 'click')::BIGINT AS n_a, count_if(event_type = 'view')::BIGINT AS n_b, sum(r) FILTER (event_type = 'click') AS r_a FROM k)
    SELECT n_a, n_b, (r_a - n_a * (n_a + 1) / 2.0)::DOUBLE AS u_a, (n_a * n_b - (r_a - n_a * (n_a + 1) / 2.0))::DOUBLE AS u_b FROM s""",
)
def mann_whitney_u(spark, d):
    return bench.mann_whitney(table(spark, d, "events").select("event_type", "value"), "event_type", "value", "click", "view")


@query("pool_runs", "SELECT variant, median(x) AS median, count(*) AS n FROM (SELECT 'a' AS variant, l_quantity AS x FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT 'b', l_quantity FROM lineitem WHERE l_linenumber = 2) GROUP BY variant")
def pool_runs(spark, d):
    runs = table(spark, d, "lineitem").withColumnRenamed("l_quantity", "x")
    both = reports.pooled({"a": runs.where("l_linenumber = 1"), "b": runs.where("l_linenumber = 2")}, ["x"], "variant")
    return bench.summary(both, ["variant"], "x").select("variant", "median", F.col("runs").alias("n"))


@query("variant_comparison", "WITH m AS (SELECT o_orderpriority AS v, median(o_totalprice) AS x FROM orders GROUP BY 1) SELECT a.v AS one, b.v AS two, round(a.x / b.x, 9) AS ratio FROM m a JOIN m b ON a.v < b.v")
def variant_comparison(spark, d):
    medians = bench.summary(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")
    return reports.ratios(medians, "o_orderpriority", "median").withColumn("ratio", F.round("ratio", 9))


@query("strided_assign", "SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1 + 8 - 3) % 8)::BIGINT AS worker FROM orders")
def strided_assign(spark, d):
    from timberline.operators.ranking import ranked

    return ranked(table(spark, d, "orders").select("o_orderkey"), [F.col("o_orderkey")]).select("o_orderkey", ((F.col("place") - 1 + 8 - 3) % 8).alias("worker"))


@query("nonzero_counters", with_logs("SELECT service || '_' || level || '_errors' AS name, count(*) AS value FROM logs WHERE level IN ('error', 'warn') GROUP BY 1 HAVING count(*) > 0"))
def nonzero_counters(spark, d):
    logs = logs_from_events(spark, d).where(F.col("level").isin("error", "warn"))
    names = logs.select(F.concat("service", F.lit("_"), "level", F.lit("_errors")).alias("name"))
    return reports.counters(names, "errors|retries|rejected|dropped")


@query("union_dead_letters", with_logs("""SELECT "offset", 'unparseable' AS error FROM logs WHERE "offset" % 7 = 0 UNION ALL SELECT "offset", 'HTTP 400' FROM logs WHERE "offset" % 11 = 0"""))
def union_dead_letters(spark, d):
    logs = logs_from_events(spark, d)
    return reports.pooled({"unparseable": logs.where("offset % 7 = 0"), "HTTP 400": logs.where("offset % 11 = 0")}, ["offset"], "error")


@query("distinct_first_seen", with_logs(r"""SELECT regexp_extract(message, 'user=(\d+)', 1) AS user_ref, min("offset") AS first_seen FROM logs GROUP BY 1"""))
def distinct_first_seen(spark, d):
    return reports.first_seen(logs_from_events(spark, d), F.regexp_extract("message", r"user=(\d+)", 1), "user_ref")


@query("level_by_host", with_logs("SELECT host, count_if(level = 'debug')::BIGINT AS debug, count_if(level = 'info')::BIGINT AS info, count_if(level = 'warn')::BIGINT AS warn, count_if(level = 'error')::BIGINT AS error FROM logs GROUP BY host"))
def level_by_host(spark, d):
    return reports.level_matrix(logs_from_events(spark, d), "host", ("debug", "info", "warn", "error"))


@query("share_indexed", with_logs("""SELECT round((count_if(indexed_at < TIMESTAMP '2024-01-15 00:00:00') - count_if(indexed_at < TIMESTAMP '2024-01-10 00:00:00')) / (count_if(observed_at < TIMESTAMP '2024-01-15 00:00:00') - count_if(observed_at < TIMESTAMP '2024-01-10 00:00:00')), 9) AS share FROM logs"""))
def share_indexed(spark, d):
    return reports.indexed_share(logs_from_events(spark, d), "2024-01-10", "2024-01-15").withColumn("share", F.round("share", 9))


@query(
    "contiguous_ack",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag <> 'A' AS acked FROM lineitem), g AS (SELECT *, bool_and(acked) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE UNBOUNDED PRECEDING) AS ok FROM l)
    SELECT l_orderkey, max(l_linenumber) FILTER (ok) AS "cursor" FROM g GROUP BY l_orderkey""",
)
def contiguous_ack(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_returnflag") != "A").alias("acked"))
    return sequences.contiguous_prefix(rows, ["l_orderkey"], "l_linenumber", "acked")


@query(
    "epoch_assign",
    """WITH f AS (SELECT user_id AS path, event_id, value AS size, (event_id // 1000) AS inode FROM events), m AS (SELECT *, CASE WHEN size < lag(size) OVER o OR inode <> lag(inode) OVER o THEN 1 ELSE 0 END AS n FROM f WINDOW o AS (PARTITION BY path ORDER BY event_id))
    SELECT path, event_id, sum(n) OVER (PARTITION BY path ORDER BY event_id)::BIGINT AS epoch FROM m""",
)
def epoch_assign(spark, d):
    f = table(spark, d, "events").select(F.col("user_id").alias("path"), "event_id", F.col("value").alias("size"), F.floor(F.col("event_id") / 1000).alias("inode"))
    return sequences.epochs(f, "path", "event_id", "size", "inode").select("path", "event_id", "epoch")


@query(
    "token_bucket",
    """WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS rn FROM events),
    s AS (SELECT user_id, event_id, t, rn, 4.0::DOUBLE AS rest, true AS allowed, 0::BIGINT AS wait_ms FROM e WHERE rn = 1
      UNION ALL
      SELECT e.user_id, e.event_id, e.t, e.rn, CASE WHEN h >= 1 THEN h - 1 ELSE h END, h >= 1, CASE WHEN h >= 1 THEN 0 ELSE ceil((1 - h) * 5000000.0)::BIGINT END
      FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1, LATERAL (SELECT least(5.0::DOUBLE, s.rest + greatest(e.t - s.t, 0) * 2e-07::DOUBLE) AS h))
    SELECT user_id, event_id, allowed, wait_ms FROM s""",
)
def token_bucket(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint").alias("t"))
    return sequences.token_bucket(e, "user_id", "event_id", "t", rate=0.0002, burst=5)


@query("stall_detection", "WITH r AS (SELECT event_id AS at_s, least(event_id // 7, 100) AS n FROM events), s AS (SELECT n, min(at_s) AS since FROM r GROUP BY n) SELECT min(at_s) AS stalled_at FROM r JOIN s USING (n) WHERE at_s - since >= 30")
def stall_detection(spark, d):
    r = table(spark, d, "events").select(F.col("event_id").alias("at_s"), F.least(F.floor(F.col("event_id") / 7), F.lit(100)).alias("n"))
    return sequences.stalled_at(r, "at_s", "n", 30)


@query("api_key_lookup", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN 'team-' || (o_orderkey % 5) END AS service FROM orders")
def api_key_lookup(spark, d):
    from timberline.service.keys import KeyMap

    keys = KeyMap.parse("key-0:team-0, key-1:team-1,key-2:team-2")
    presented = F.concat(F.lit("key-"), F.col("o_orderkey") % 5)
    return table(spark, d, "orders").select("o_orderkey", keys.service_column(presented).alias("service"))


@query("replay_loop", """WITH l AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS i, n_name FROM nation WHERE n_regionkey <> 3), c AS (SELECT count(*) AS k FROM l) SELECT g.i AS seq, l.n_name AS line FROM range(1000) g(i), c JOIN l ON true WHERE l.i = g.i % c.k""")
def replay_loop(spark, d):
    from timberline.sources.generators import replay

    lines = table(spark, d, "nation").select("n_nationkey", F.when(F.col("n_regionkey") == 3, "").otherwise(F.concat("n_name", F.lit("\r\r"))).alias("line"))
    return replay(spark, lines, "line", ["n_nationkey"], 1000)


@query("error_burst", """SELECT i AS seq, '081109 ' || lpad((200000 + i // 60 % 60 * 100 + i % 60)::VARCHAR, 6, '0') || ' ' || (100 + i) || ' ERROR dfs.DataNode$PacketResponder: block blk_' || i || ' failed' AS line FROM range(500) g(i)""")
def error_burst(spark, d):
    from timberline.sources.generators import burst

    return burst(spark, 500)


@query("prom_text", with_logs("""SELECT 'logs_total' AS name, service, level, count(*)::DOUBLE AS value FROM logs GROUP BY service, level"""))
def prom_text(spark, d):
    """Samples read back from the text exposition of counters."""
    from timberline.sources.prometheus import parse_samples

    n = logs_from_events(spark, d).groupBy("service", "level").agg(F.count("*").alias("n"))
    text = n.select(F.format_string('logs_total{service="%s",level="%s"} %d', "service", "level", "n").alias("value"))
    return parse_samples(text).select("name", F.col("labels")["service"].alias("service"), F.col("labels")["level"].alias("level"), "value")


@query("docker_stats", "SELECT o_orderstatus AS container, round(avg(o_orderkey % 400 / 2.0), 6) AS mean, max(o_orderkey % 400 / 2.0) AS peak FROM orders GROUP BY 1")
def docker_stats(spark, d):
    from timberline.sources.prometheus import parse_stats

    lines = table(spark, d, "orders").select(F.format_string("%s cpu=%.1f%% mem=1MiB", "o_orderstatus", F.col("o_orderkey") % 400 / 2.0).alias("value"))
    return parse_stats(lines).groupBy("container").agg(F.round(F.avg("cpu"), 6).alias("mean"), F.max("cpu").alias("peak"))


@query(
    "rate_quantile",
    f"""WITH f AS (SELECT event_type, epoch_us(ts) // 86400000000 AS day, value FROM events),
    p AS (SELECT event_type, day, b AS bound, count_if(value <= b)::BIGINT AS n FROM f, (SELECT unnest([1.0, 4.0, 16.0, 64.0, 256.0, 'Infinity'::DOUBLE]) AS b) GROUP BY ALL),
    k AS (SELECT *, sum(n) OVER (PARTITION BY event_type, bound, day // 5 ORDER BY day)::BIGINT AS value FROM p),
    u AS (SELECT *, lag(value) OVER (PARTITION BY event_type, bound ORDER BY day) AS b FROM k),
    h AS (SELECT day, bound, sum(CASE WHEN b IS NULL THEN 0 WHEN value < b THEN value ELSE value - b END)::BIGINT AS n FROM u GROUP BY ALL),
    l AS (SELECT *, lag(bound, 1, 0.0) OVER o AS b0, lag(n, 1, 0) OVER o AS c0, max(n) OVER (PARTITION BY day) AS total FROM h WINDOW o AS (PARTITION BY day ORDER BY bound))
    SELECT day, round(CASE WHEN isinf(bound) THEN b0 ELSE b0 + (bound - b0) * (0.5 * total - c0) / (n - c0) END, 6) AS p50 FROM l WHERE total > 0 AND n >= 0.5 * total AND c0 < 0.5 * total""",
)
def rate_quantile(spark, d):
    """Median of each day's increase of a histogram's counters, which restart every fifth day, summed over its series."""
    e = table(spark, d, "events").select("event_type", "value", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).alias("day"))
    per = metrics.cumulative_histogram(e, ["event_type", "day"], "value", [1.0, 4.0, 16.0, 64.0, 256.0])
    since = Window.partitionBy("event_type", "bound", F.floor(F.col("day") / 5)).orderBy("day")
    counters = per.withColumn("counter", F.sum("count").over(since)).withColumn("at_s", F.col("day") * 86_400)
    grown = metrics.increases(counters, ["event_type", "bound"], "at_s", "counter", chunk=10 * 86_400)
    summed = grown.groupBy("day", "bound").agg(F.sum("_up").alias("count"))
    return metrics.histogram_quantile(summed, ["day"], 0.5).where("value IS NOT NULL AND NOT isnan(value)").select("day", F.round("value", 6).alias("p50"))


@query("label_filter", with_logs("""SELECT l."offset", n.n_name AS host FROM logs l JOIN nation n ON n.n_nationkey = l."offset" % 25 JOIN region r ON r.r_regionkey = n.n_regionkey WHERE r.r_name = 'ASIA'"""))
def label_filter(spark, d):
    """Lines of the containers that a label selects, with the container's name as host."""
    from timberline.sources.containers import named

    path = lambda key: F.concat(F.lit("/var/lib/containers/"), key.cast("string"))
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    containers = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        path(F.col("n_nationkey")).alias("folder"), F.col("n_name").alias("name"), F.create_map(F.lit("app"), "r_name").alias("labels")
    )
    lines = logs_from_events(spark, d).select("offset", F.concat(path(F.col("offset") % 25), F.lit("/json.log")).alias("source"))
    return named(lines, containers, "app=ASIA").select("offset", "host")


@query("tail_projection", with_logs("""SELECT id, service, (epoch_us("timestamp") // 1000) AS ts_ms, level, message, host, source, "offset" FROM logs"""))
def tail_projection(spark, d):
    return events(logs_from_events(spark, d)).select("id", "service", F.unix_millis("timestamp").alias("ts_ms"), "level", "message", "host", "source", "offset")
