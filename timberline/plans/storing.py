"""Queries on validation, routing, the store, search and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from timberline.operators import audit, reports, search, store, validate
from timberline.plans.registry import query, with_logs
from timberline.sources.tables import logs_from_events, table

NOW = "2026-01-01 00:00:00"

BROKEN = """
in_ AS (SELECT "offset",
  CASE WHEN "offset" % 10 = 1 THEN 'nope' ELSE id END AS id,
  CASE WHEN "offset" % 10 = 2 THEN '' WHEN "offset" % 10 = 3 THEN repeat('x', 65537) ELSE message END AS message,
  CASE WHEN "offset" % 10 = 4 THEN NULL WHEN "offset" % 10 = 5 THEN TIMESTAMP '2026-01-02 01:00:00' ELSE "timestamp" END AS "timestamp",
  CASE WHEN "offset" % 10 = 6 THEN NULL ELSE observed_at END AS observed_at,
  CASE WHEN "offset" % 10 = 7 THEN '99' ELSE level END AS level,
  CASE WHEN "offset" % 10 = 8 THEN '' ELSE source END AS source FROM logs),
checked AS (SELECT *, CASE WHEN NOT regexp_full_match(id, '[0-9a-f]{32}') THEN 'invalid id' WHEN message = '' THEN 'empty message' WHEN strlen(message) > 65536 THEN 'message too large'
  WHEN "timestamp" IS NULL THEN 'missing or invalid timestamp' WHEN "timestamp" > TIMESTAMP '2026-01-02 00:00:00' THEN 'timestamp too far in the future' WHEN observed_at IS NULL THEN 'missing or invalid observed_at'
  WHEN level NOT IN ('unknown', 'trace', 'debug', 'info', 'warn', 'error', 'fatal') THEN 'unknown level' WHEN source = '' THEN 'missing source' END AS reason FROM in_)"""


def broken(spark, d):
    k = F.col("offset") % 10
    null = F.lit(None).cast("timestamp")
    return logs_from_events(spark, d).withColumns({
        "id": F.when(k == 1, "nope").otherwise(F.col("id")),
        "message": F.when(k == 2, "").when(k == 3, F.repeat(F.lit("x"), 65537)).otherwise(F.col("message")),
        "timestamp": F.when(k == 4, null).when(k == 5, F.lit("2026-01-02 01:00:00").cast("timestamp")).otherwise(F.col("timestamp")),
        "observed_at": F.when(k == 6, null).otherwise(F.col("observed_at")),
        "level": F.when(k == 7, "99").otherwise(F.col("level")),
        "source": F.when(k == 8, "").otherwise(F.col("source")),
    })


@query("validate_reasons", with_logs('SELECT "offset", reason FROM checked', BROKEN.strip()))
def validate_reasons(spark, d):
    return broken(spark, d).select("offset", validate.reason(F.lit(NOW).cast("timestamp")).alias("reason"))


@query("route_accept_reject", with_logs("""SELECT coalesce(reason, 'accepted') AS outcome, CASE WHEN reason IS NULL THEN 'billing' END AS service, count(*) AS n FROM checked GROUP BY 1, 2""", BROKEN.strip()))
def route_accept_reject(spark, d):
    good, bad = validate.route(broken(spark, d), F.lit(NOW).cast("timestamp"), F.lit("billing"))
    both = good.select(F.lit("accepted").alias("outcome"), "service").unionByName(bad.select(F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("service")))
    return both.groupBy("outcome", "service").agg(F.count("*").alias("n"))


@query(
    "dead_letters",
    with_logs("""SELECT "offset" AS source_offset, CASE "offset" % 7 WHEN 0 THEN 'unparseable: no record' WHEN 1 THEN 'invalid: invalid id' WHEN 2 THEN 'invalid: missing service' END AS error, 'logs' AS source_topic, ("offset" % 6)::INTEGER AS source_partition
                 FROM logs WHERE "offset" % 7 < 3"""),
)
def dead_letters(spark, d):
    k = F.col("offset") % 7
    logs = logs_from_events(spark, d)
    record = F.to_json(
        F.struct(
            F.when(k == 1, "nope").otherwise(F.col("id")).alias("id"), F.when(k == 2, "").otherwise(F.col("service")).alias("service"), "timestamp", "observed_at",
            "level", "message", "host", "agent_id", "source", "offset", "epoch",
        )
    )
    raw = logs.select(
        F.when(k == 0, F.lit("garbage")).otherwise(record).cast("binary").alias("value"), F.lit("logs").alias("topic"),
        (F.col("offset") % 6).cast("int").alias("partition"), F.col("offset").alias("source_offset"),
    )
    _, dead = validate.decode(raw, F.lit(NOW).cast("timestamp"))
    return dead.select("source_offset", "error", "source_topic", "source_partition")


WRITES = """writes AS (SELECT id, level, indexed_at FROM logs UNION ALL SELECT id, 'fatal', indexed_at + INTERVAL 1 HOUR FROM logs WHERE "offset" % 3 = 0)"""


def writes(spark, d):
    logs = logs_from_events(spark, d)
    again = logs.where(F.col("offset") % 3 == 0).withColumns({"level": F.lit("fatal"), "indexed_at": F.col("indexed_at") + F.expr("INTERVAL '1' HOUR")})
    return logs.unionByName(again)


@query("upsert_last_write", with_logs("SELECT id, arg_max(level, indexed_at) AS level, epoch_us(max(indexed_at)) AS at_us FROM writes GROUP BY id", WRITES))
def upsert_last_write(spark, d):
    return store.last_write(writes(spark, d).select("id", "level", "indexed_at")).select("id", "level", F.unix_micros("indexed_at").alias("at_us"))


@query("redundant_writes", with_logs("SELECT count(*)::BIGINT AS writes, count(DISTINCT id) AS documents, (count(*) - count(DISTINCT id))::BIGINT AS redundant FROM writes", WRITES))
def redundant_writes(spark, d):
    return audit.redundant_writes(writes(spark, d))


@query("doc_projection", with_logs("""SELECT id, service, (epoch_us("timestamp") // 1000) AS ts_ms, (epoch_us(observed_at) // 1000) AS obs_ms, (epoch_us(indexed_at) // 1000) AS idx_ms, level, message, host, agent_id, source, "offset", epoch::BIGINT AS epoch FROM logs"""))
def doc_projection(spark, d):
    return logs_from_events(spark, d).select(
        "id", "service", F.unix_millis("timestamp").alias("ts_ms"), F.unix_millis("observed_at").alias("obs_ms"), F.unix_millis("indexed_at").alias("idx_ms"),
        "level", "message", "host", "agent_id", "source", "offset", "epoch",
    )


ORDER = 'ORDER BY (epoch_us("timestamp") // 1000) DESC, id DESC'


def _search(name: str, where: str, limit: int = 100, **query_args) -> None:
    sql = with_logs(f'SELECT id, (epoch_us("timestamp") // 1000) AS ts_ms, service, level FROM logs WHERE {where} {ORDER} LIMIT {limit}')

    @query(name, sql)
    def run(spark, d):
        q = search.Query(limit=limit, **query_args)
        return search.page(logs_from_events(spark, d), q).select("id", search.ms().alias("ts_ms"), "service", "level")


def _time(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


RANGE = "\"timestamp\" >= TIMESTAMP '2024-01-05 00:00:00' AND \"timestamp\" < TIMESTAMP '2024-01-20 12:00:00'"
_search("search_service", "service = 'svc-1'", service="svc-1")
_search("search_host", "host = 'host-2'", host="host-2")
_search("search_level", "level = 'error'", level="error")
_search("search_range", RANGE, start=_time("2024-01-05T00:00:00"), end=_time("2024-01-20T12:00:00"))
_search("search_text", "list_has_all(regexp_extract_all(lower(message), '[a-z0-9_]+'), ['purchase', 'user'])", text="User purchase")
_search("search_all", "true")
_search("search_top_k", "service = 'svc-3'", limit=1000, service="svc-3")
_search("search_service_level_range", f"service = 'svc-1' AND level = 'info' AND {RANGE}", service="svc-1", level="info", start=_time("2024-01-05T00:00:00"), end=_time("2024-01-20T12:00:00"))
_search(
    "search_after_cursor", "((epoch_us(\"timestamp\") // 1000) < 1705276800000 OR (epoch_us(\"timestamp\") // 1000) = 1705276800000 AND id < '8')",
    after=search.SortKey(1705276800000, "8"),
)


@query(
    "search_after_ties",
    with_logs("""SELECT id, h AS ts_ms FROM (SELECT id, (epoch_us(date_trunc('hour', "timestamp")) // 1000) AS h FROM logs) WHERE h < 1705276800000 OR h = 1705276800000 AND id < '8' ORDER BY h DESC, id DESC LIMIT 200"""),
)
def search_after_ties(spark, d):
    logs = logs_from_events(spark, d).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    return search.page(logs, search.Query(limit=200, after=search.SortKey(1705276800000, "8"))).select("id", search.ms().alias("ts_ms"))


@query("pagination_walk", with_logs(f"SELECT id, ((row_number() OVER ({ORDER}) - 1) // 700)::BIGINT AS page, row_number() OVER ({ORDER}) AS place FROM logs"))
def pagination_walk(spark, d):
    return search.numbered(logs_from_events(spark, d), 700).select("id", "page", "place")


@query("pagination_full", with_logs(f"""SELECT id, service, (epoch_us("timestamp") // 1000) AS ts_ms, level, message, host, source, "offset", event_type, value, ((row_number() OVER ({ORDER}) - 1) // 700)::BIGINT AS page, row_number() OVER ({ORDER}) AS place FROM logs"""))
def pagination_full(spark, d):
    """The walk over rows with all their columns."""
    out = search.numbered(logs_from_events(spark, d), 700)
    return out.select("id", "service", search.ms().alias("ts_ms"), "level", "message", "host", "source", "offset", "event_type", "value", "page", "place")


def _stored(spark, d):
    """A store on disk: all logs in two batches, a third of them delivered again later with another level, one day merged."""
    from timberline.sources.tables import LOG_SCHEMA
    from timberline.staging import folder

    path = folder(spark, "store")
    store.create(spark, path)
    rows = writes(spark, d).select(*LOG_SCHEMA.names, F.to_date("timestamp").alias("event_date"))
    late = F.col("level") == "fatal"
    store.append(spark, path, rows.where(~late & (F.col("offset") % 2 == 0)), 0)
    store.append(spark, path, rows.where(~late & (F.col("offset") % 2 == 1)), 1)
    store.append(spark, path, rows.where(late), 2)
    store.append(spark, path, rows.where(late), 2)  # delivered once more
    first = store.read(spark, path).agg(F.min("event_date")).first()[0]
    if first is not None:
        store.compact(spark, path, first)
    return path


STORE = WRITES + """, kept AS (SELECT w.id, arg_max(w.level, w.indexed_at) AS level FROM writes w GROUP BY w.id)"""


@query("store_current", with_logs("""SELECT l.id, k.level, l.service, (epoch_us(l."timestamp") // 1000) AS ts_ms, l.message, l."offset" FROM logs l JOIN kept k USING (id)""", STORE))
def store_current(spark, d):
    """What a written store holds after batches, redelivery and a merge."""
    return store.current(spark, _stored(spark, d)).select("id", "level", "service", search.ms().alias("ts_ms"), "message", "offset")


def _page(spark, path, q, *names):
    """A page of a store, as its search gives it."""
    from timberline.operators.storesearch import StoreSearch, key_of

    schema = store.read(spark, path).select("id", search.ms().alias("ts_ms"), *names).schema
    return spark.createDataFrame([(r.id, key_of(r).ms, *(r[n] for n in names)) for r in StoreSearch(spark, path).rows(q)], schema)


@query("store_search", with_logs(f"""SELECT l.id, (epoch_us(l."timestamp") // 1000) AS ts_ms FROM logs l JOIN kept k USING (id) WHERE k.level = 'fatal' AND l.service = 'svc-1' AND {RANGE} {ORDER} LIMIT 50""", STORE))
def store_search(spark, d):
    """A page of a written store, days outside of the range pruned."""
    q = search.Query(service="svc-1", level="fatal", start=_time("2024-01-05T00:00:00"), end=_time("2024-01-20T12:00:00"), limit=50)
    return _page(spark, _stored(spark, d), q)


@query("store_search_replaced", with_logs(f"""SELECT l.id, (epoch_us(l."timestamp") // 1000) AS ts_ms, k.level FROM logs l JOIN kept k USING (id) WHERE k.level = 'info' {ORDER} LIMIT 1000""", STORE))
def store_search_replaced(spark, d):
    """A page of a written store for a level that many of its rows had before they were written again."""
    return _page(spark, _stored(spark, d), search.Query(level="info", limit=1000), "level")


@query("store_search_text", with_logs(f"""SELECT l.id, (epoch_us(l."timestamp") // 1000) AS ts_ms, l.message FROM logs l WHERE list_has_all(regexp_extract_all(lower(l.message), '[a-z0-9_]+'), ['signup', '7']) {ORDER} LIMIT 1000""", STORE))
def store_search_text(spark, d):
    """A page of a written store for terms; the index names the files that may hold them."""
    return _page(spark, _stored(spark, d), search.Query(text="SIGNUP 7", limit=1000), "message")


@query("store_walk", with_logs(f"""SELECT l.id, ((row_number() OVER ({ORDER.replace('"timestamp"', 'l."timestamp"').replace(' id ', ' l.id ')}) - 1) // 500)::BIGINT AS page FROM logs l JOIN kept k USING (id) WHERE l.service = 'svc-2'""", STORE))
def store_walk(spark, d):
    """All pages of a service in a written store."""
    return search.numbered(store.current(spark, _stored(spark, d)).where("service = 'svc-2'"), 500).select("id", "page")


UNSEEN = """batch AS (SELECT * FROM logs WHERE "offset" % 5 <> 1), there AS (SELECT * FROM logs WHERE "offset" % 3 <> 0)"""


@query("store_unseen", with_logs("""SELECT id, "offset", level FROM batch WHERE id NOT IN (SELECT id FROM there)""", UNSEEN))
def store_unseen(spark, d):
    """The records of a batch that no earlier batch of the store holds, whatever their day."""
    from timberline.operators import storeindex
    from timberline.sources.tables import LOG_SCHEMA
    from timberline.staging import folder, written

    path = folder(spark, "store")
    store.create(spark, path)
    rows = logs_from_events(spark, d).select(*LOG_SCHEMA.names, F.to_date("timestamp").alias("event_date"))
    for i in (1, 2):
        store.append(spark, path, rows.where(F.col("offset") % 3 == i), i)
    batch = written(rows.where(F.col("offset") % 5 != 1), "batch")
    return storeindex.unseen(spark, path, batch)[0].select("id", "offset", "level")


@query("count_by_source", with_logs("SELECT source, count(*) AS n FROM logs GROUP BY source"))
def count_by_source(spark, d):
    return reports.count_by(logs_from_events(spark, d), "source")


@query("ids_lookup", with_logs("""SELECT id, service FROM logs WHERE "offset" IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0)"""))
def ids_lookup(spark, d):
    wanted = table(spark, d, "orders").where("o_orderkey % 11 = 0").select(F.col("o_orderkey").alias("offset"))
    return reports.lookup(logs_from_events(spark, d), wanted, "offset").select("id", "service")


STORED = """stored AS (SELECT * FROM logs WHERE "offset" % 97 <> 5), expected AS (SELECT id FROM logs WHERE "offset" % 50 <> 7)"""


def _sides(spark, d):
    logs = logs_from_events(spark, d)
    return logs.where(F.col("offset") % 50 != 7), logs.where(F.col("offset") % 97 != 5)


@query("audit_missing", with_logs("SELECT id FROM expected WHERE id NOT IN (SELECT id FROM stored)", STORED))
def audit_missing(spark, d):
    return audit.missing(*_sides(spark, d))


@query("audit_found", with_logs("SELECT id FROM expected WHERE id IN (SELECT id FROM stored)", STORED))
def audit_found(spark, d):
    return audit.found(*_sides(spark, d))


REPORT = with_logs(
    """SELECT e AS expected, i AS indexed, m AS missing, i - (e - m) AS unexpected, m = 0 AND i - (e - m) <= 0 AS zero_loss, round(s, 3) AS seconds, round((i - (i - (e - m))) / s, 6) AS rate FROM (
       SELECT (SELECT count(*) FROM expected) AS e, (SELECT count(*) FROM stored) AS i, (SELECT count(*) FROM expected WHERE id NOT IN (SELECT id FROM stored)) AS m,
              (SELECT (epoch_us(max(indexed_at)) - epoch_us(min(observed_at))) / 1e6 FROM stored) AS s)""",
    STORED,
)


def _rounded(report):
    return report.withColumns({"seconds": F.round("seconds", 3), "rate": F.round("rate", 6)})


@query("audit_report", REPORT)
def audit_report(spark, d):
    expected, stored = _sides(spark, d)
    return _rounded(audit.report(expected, stored, "/var/log/events.log"))


@query("audit_report_digests", REPORT)
def audit_report_digests(spark, d):
    """The same report, of which only buckets whose digests differ are looked up by id."""
    expected, stored = _sides(spark, d)
    return _rounded(audit.report_by_digests(expected, stored, "/var/log/events.log"))


@query("audit_differing", with_logs("""SELECT id, "offset", false AS stored FROM logs WHERE "offset" % 50 <> 7 AND "offset" % 97 = 5 UNION ALL SELECT id, "offset", true FROM logs WHERE "offset" % 50 = 7 AND "offset" % 97 <> 5"""))
def audit_differing(spark, d):
    """What only one side has, of the buckets that digests tell apart."""
    expected, stored = audit.differing(*_sides(spark, d))
    one, two = (a.join(b.select("id"), "id", "left_anti").select("id", "offset") for a, b in ((expected, stored), (stored, expected)))
    return one.withColumn("stored", F.lit(False)).unionByName(two.withColumn("stored", F.lit(True)))


@query("span_throughput", with_logs("SELECT epoch_us(min(observed_at)) AS first_us, epoch_us(max(indexed_at)) AS last_us, count(*) AS n FROM logs"))
def span_throughput(spark, d):
    return reports.span(logs_from_events(spark, d))


@query(
    "latency_percentiles",
    with_logs("SELECT round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.9), 6) AS p90, round(quantile_cont(x, 0.99), 6) AS p99, round(max(x), 6) AS max_ms FROM (SELECT (epoch_us(indexed_at) - epoch_us(observed_at)) / 1000.0 AS x FROM logs)"),
)
def latency_percentiles(spark, d):
    out = audit.latency(logs_from_events(spark, d))
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


LINES_SQL = """strftime("timestamp", '%Y-%m-%d %H:%M:%S') || ',' || lpad((epoch_us("timestamp") % 1000000 // 1000)::VARCHAR, 3, '0') || ' ' || upper(level) || ' ' || message"""
INGESTED = with_logs(f"""SELECT {LINES_SQL} AS line, level, (epoch_us("timestamp") // 1000) AS ts_ms, 'files' AS service FROM logs""")


def _ingested(spark, d, run):
    """The stored records of the log lines, written to files and ingested from there."""
    from timberline.staging import folder
    from timberline.streaming import ingest

    path = folder(spark, "lines")
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss,SSS")
    logs_from_events(spark, d).select(F.concat_ws(" ", stamp, F.upper("level"), "message").alias("value")).write.text(f"{path}/in")
    config = ingest.Config(f"{path}/store", f"{path}/dead", f"{path}/checkpoint", "files")
    run(ingest, f"{path}/in", config)
    return store.current(spark, config.store).select(F.col("message").alias("line"), "level", search.ms().alias("ts_ms"), "service")


@query("ingest_stream", INGESTED)
def ingest_stream(spark, d):
    """Files to the store as a stream: framed, identified, parsed, validated, appended."""
    return _ingested(spark, d, lambda ingest, path, config: ingest.start(spark, path, config).awaitTermination())


@query("ingest_blocks", INGESTED)
def ingest_blocks(spark, d):
    """Files to the store in one batch, split into blocks; twice, as after a failure."""

    def run(ingest, path, config):
        for _ in range(2):
            ingest.load(spark, path, config)

    return _ingested(spark, d, run)
