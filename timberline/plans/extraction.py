"""Queries on extraction: identifiers, framing, timestamps, levels, container lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from timberline.functions import framing, ids, levels, text, timestamps
from timberline.plans.registry import query, with_logs
from timberline.sources.tables import logs_from_events, table


@query("log_id", with_logs('SELECT "offset", id FROM logs'))
def log_id(spark, d):
    return logs_from_events(spark, d).select("offset", "id")


VARIANT = """CASE "offset" % 5 WHEN 0 THEN id WHEN 1 THEN upper(id) WHEN 2 THEN substring(id, 1, 31) WHEN 3 THEN id || '0' ELSE '' END"""


@query("valid_log_id", with_logs(f"""SELECT "offset", regexp_full_match({VARIANT}, '[0-9a-f]{{32}}') AS valid FROM logs"""))
def valid_log_id(spark, d):
    v = F.expr(VARIANT.replace('"offset"', "offset"))
    return logs_from_events(spark, d).select("offset", ids.valid_log_id(v).alias("valid"))


@query("daily_index", with_logs("""SELECT 'logs-' || strftime("timestamp", '%Y.%m.%d') AS index_name, count(*) AS n FROM logs GROUP BY 1"""))
def daily_index(spark, d):
    return logs_from_events(spark, d).groupBy(ids.index_name("logs", F.col("timestamp")).alias("index_name")).agg(F.count("*").alias("n"))


FRAMES = """
WITH parts AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
lines AS (SELECT doc_id, line, strlen(line) AS n, sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - strlen(line) - 1 AS pos0 FROM parts)
"""


@query("frame_lines", FRAMES + 'SELECT doc_id, pos0::BIGINT AS "offset", n AS n_bytes, line FROM lines WHERE n > 0')
def frame_lines(spark, d):
    return framing.frame(table(spark, d, "documents"), "doc_id", "text")


@query(
    "frame_long_lines",
    FRAMES + ', cut AS (SELECT doc_id, pos0, n, hex(encode(line)) AS h, unnest(range((n + 63) // 64)) AS k FROM lines WHERE n > 0) SELECT doc_id, (pos0 + 64 * k)::BIGINT AS "offset", least(64, n - 64 * k)::BIGINT AS n_bytes, substring(h, 128 * k + 1, 128) AS bytes FROM cut',
)
def frame_long_lines(spark, d):
    rows = framing.frame(table(spark, d, "documents"), "doc_id", "text", max_line=64, raw=True)
    return rows.select("doc_id", "offset", "n_bytes", F.hex("line").alias("bytes"))


AT = "(o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400))"


def _parse(name: str, form: str, parser, tail: str = " message", extra: str = "0", head: str = "") -> None:
    sql = f"SELECT o_orderkey, epoch_us({AT} + to_milliseconds({extra})) AS at_us FROM orders"

    @query(f"parse_ts_{name}", sql)
    def run(spark, d):
        at = F.timestamp_add("MILLISECOND", F.expr(extra) + (F.col("o_orderkey") % 86400) * 1000, F.col("o_orderdate").cast("timestamp"))
        line = F.concat(F.lit(head), F.date_format(at, form), F.lit(tail))
        return table(spark, d, "orders").select("o_orderkey", F.unix_micros(parser(line)).alias("at_us"))


_parse("hdfs", "yyMMdd HHmmss", timestamps.hdfs, " 148 INFO dfs.DataNode: block")
_parse("log4j", "yyyy-MM-dd HH:mm:ss,SSS", timestamps.log4j, " WARN [main] x", "o_orderkey % 1000")
_parse("sql", "yyyy-MM-dd HH:mm:ss", timestamps.sql_style)
_parse("spark", "yy/MM/dd HH:mm:ss", timestamps.spark_style, " INFO executor.Executor: x")
_parse("apache", "EEE MMM dd HH:mm:ss yyyy", timestamps.apache, "] [error] x", head="[")
_parse("rfc3339", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", timestamps.rfc3339, " level=info x", "o_orderkey % 1000")


@query(
    "parse_ts_syslog",
    f"""WITH t AS (SELECT o_orderkey, {AT} AS t0 FROM orders),
    y AS (SELECT o_orderkey, make_timestamp(2026, month(t0), 1, hour(t0), minute(t0), second(t0)::DOUBLE) + to_days(day(t0)::INTEGER - 1) AS this,
                 make_timestamp(2025, month(t0), 1, hour(t0), minute(t0), second(t0)::DOUBLE) + to_days(day(t0)::INTEGER - 1) AS last FROM t)
    SELECT o_orderkey, epoch_us(CASE WHEN this > TIMESTAMP '2026-03-02 00:00:00' THEN last ELSE this END) AS at_us FROM y""",
)
def parse_ts_syslog(spark, d):
    at = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate").cast("timestamp"))
    line = F.concat(F.date_format(at, "MMM dd HH:mm:ss"), F.lit(" LabSZ sshd[24200]: x"))
    now = F.lit("2026-03-01 00:00:00").cast("timestamp")
    return table(spark, d, "orders").select("o_orderkey", F.unix_micros(timestamps.syslog(line, now)).alias("at_us"))


@query("parse_ts_any", f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE epoch_us({AT}) END AS at_us FROM orders")
def parse_ts_any(spark, d):
    at = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate").cast("timestamp"))
    k = F.col("o_orderkey") % 4
    line = (
        F.when(k == 0, F.concat(F.date_format(at, "yyMMdd HHmmss"), F.lit(" 1 INFO x")))
        .when(k == 1, F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(",000 WARN x")))
        .when(k == 2, F.concat(F.lit("["), F.date_format(at, "EEE MMM dd HH:mm:ss yyyy"), F.lit("] [error] x")))
        .otherwise("no time here")
    )
    now = F.lit("2026-03-01 00:00:00").cast("timestamp")
    return table(spark, d, "orders").select("o_orderkey", F.unix_micros(timestamps.parse_timestamp(line, now)).alias("at_us"))


LINE = """CASE "offset" % 8
  WHEN 0 THEN '240229 000001 7 ' || upper(level) || ' store: ' || message
  WHEN 1 THEN '<' || level || '> pool-' || "offset" || ' ' || message
  WHEN 2 THEN '2031-07-04 00:00:00,001 Notice tick ' || message
  WHEN 3 THEN 'one two three four five six seven eight ERROR ' || message
  WHEN 4 THEN 'one two three four five six seven severe: ' || message
  WHEN 5 THEN '(crit), ' || message
  WHEN 6 THEN 'x  y ' || chr(9) || ' emerg ' || message
  ELSE 'plain text without any' END"""


@query(
    "parse_level_tokens",
    with_logs(
        f"""SELECT "offset", coalesce(list_filter(list_transform(list_slice(list_filter(string_split_regex({LINE}, '\\s+'), lambda x: x <> ''), 1, 8),
            lambda x: CASE upper(trim(x, '[]():,<>'))
              WHEN 'TRACE' THEN 'trace' WHEN 'TRCE' THEN 'trace' WHEN 'DEBUG' THEN 'debug' WHEN 'DBUG' THEN 'debug' WHEN 'INFO' THEN 'info' WHEN 'NOTICE' THEN 'info'
              WHEN 'WARN' THEN 'warn' WHEN 'WARNING' THEN 'warn' WHEN 'ERROR' THEN 'error' WHEN 'ERR' THEN 'error' WHEN 'SEVERE' THEN 'error' WHEN 'FAIL' THEN 'error'
              WHEN 'FATAL' THEN 'fatal' WHEN 'CRIT' THEN 'fatal' WHEN 'CRITICAL' THEN 'fatal' WHEN 'EMERG' THEN 'fatal' WHEN 'ALERT' THEN 'fatal' END), lambda x: x IS NOT NULL)[1], 'unknown') AS parsed FROM logs"""
    ),
)
def parse_level_tokens(spark, d):
    line = F.expr(LINE.replace('"offset"', "offset").replace("chr(9)", "'\\t'"))
    return logs_from_events(spark, d).select("offset", levels.parse_level(line).alias("parsed"))


@query(
    "parse_level_json",
    with_logs("""SELECT "offset", CASE "offset" % 4 WHEN 0 THEN level WHEN 1 THEN 'warn' WHEN 2 THEN 'fatal' ELSE 'unknown' END AS parsed FROM logs"""),
)
def parse_level_json(spark, d):
    k = F.col("offset") % 4
    line = (
        F.when(k == 0, F.to_json(F.struct(F.col("level"), F.col("message").alias("msg"))))
        .when(k == 1, F.to_json(F.struct(F.lit("loud").alias("level"), F.lit(" Warning ").alias("severity"))))
        .when(k == 2, F.to_json(F.struct(F.lit("critical").alias("log.level"), F.col("host"))))
        .otherwise(F.to_json(F.struct(F.lit("hello").alias("msg"))))
    )
    return logs_from_events(spark, d).select("offset", levels.parse_level(line).alias("parsed"))


@query(
    "docker_unwrap",
    with_logs("""SELECT "offset", CASE "offset" % 5 WHEN 1 THEN '{"unrelated":1}' WHEN 2 THEN 'plain text' ELSE message END AS message,
                 "offset" % 5 NOT IN (1, 2) AS ok, CASE WHEN "offset" % 5 NOT IN (1, 2) THEN epoch_us("timestamp") END AS at_us FROM logs WHERE "offset" % 5 <> 4"""),
)
def docker_unwrap(spark, d):
    k = F.col("offset") % 5
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    shell = lambda body: F.to_json(F.struct(body.alias("log"), F.lit("stdout").alias("stream"), stamp.alias("time")))
    line = (
        F.when(k == 1, '{"unrelated":1}').when(k == 2, "plain text").when(k == 4, shell(F.lit("\r\n")))
        .otherwise(shell(F.concat("message", F.when(k == 3, "\r\n").otherwise("\n"))))
    )
    lines = logs_from_events(spark, d).select("offset", line.alias("line"))
    rows = text.unwrapped(lines, F.col("line"), "u").where("NOT u.drop")
    return rows.select("offset", "u.message", "u.ok", F.unix_micros("u.time").alias("at_us"))


@query(
    "container_lookup",
    with_logs(
        """SELECT l."offset", substring(lpad(n.n_nationkey::VARCHAR, 20, 'c'), 1, 12) AS short_id, n.n_name AS container FROM logs l JOIN nation n ON n.n_nationkey = l."offset" % 25 WHERE n.n_regionkey = 1"""
    ),
)
def container_lookup(spark, d):
    """Rows of the containers with one label, by the folder of their log; the table of containers is small by nature."""
    path = lambda key: F.concat(F.lit("/var/lib/containers/"), F.lpad(key.cast("string"), 20, "c"), F.lit("/json.log"))
    containers = table(spark, d, "nation").where("n_regionkey = 1").select(path(F.col("n_nationkey")).alias("path"), F.col("n_name").alias("container"))
    rows = logs_from_events(spark, d).select("offset", path(F.col("offset") % 25).alias("path"))
    return rows.join(containers, "path").select("offset", text.short_container_id(F.col("path")).alias("short_id"), "container")


@query(
    "level_name_map",
    with_logs("""SELECT "offset", coalesce(['unknown', 'trace', 'debug', 'info', 'warn', 'error', 'fatal'][("offset" % 9) + 1], 'unknown') AS name, CASE WHEN "offset" % 9 < 7 THEN ("offset" % 9)::INTEGER END AS back FROM logs"""),
)
def level_name_map(spark, d):
    k = F.col("offset") % 9
    name = levels.level_name(k)
    return logs_from_events(spark, d).select("offset", name.alias("name"), F.when(k < 7, levels.parse_level_name(F.upper(name))).alias("back"))


@query("escape_slack", with_logs("""SELECT "offset", replace(replace(replace('<' || message || '> & `x`', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM logs"""))
def escape_slack(spark, d):
    return logs_from_events(spark, d).select("offset", text.escape_chat(F.concat(F.lit("<"), "message", F.lit("> & `x`"))).alias("escaped"))


@query("truncate_sample", "SELECT doc_id, CASE WHEN strlen(text) > 200 THEN left(hex(encode(text)), 400) || '2E2E2E' ELSE hex(encode(text)) END AS bytes FROM documents WHERE text IS NOT NULL")
def truncate_sample(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.hex(text.truncated(F.col("text"))).alias("bytes"))


#: The term rule without look-ahead: a joiner is taken with the letter or digit behind it.
TERMS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+(?:[.:'']\p{L}[\p{L}\p{N}_]*|[.,]\p{N}[\p{L}\p{N}_]*)*')"


@query("tokenize_terms", f"SELECT doc_id, len({TERMS_SQL})::BIGINT AS n, array_to_string({TERMS_SQL}, ' ') AS terms FROM documents")
def tokenize_terms(spark, d):
    found = text.terms(F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", F.size(found).cast("bigint").alias("n"), F.array_join(found, " ").alias("terms"))


@query("backoff_ceiling", "SELECT o_orderkey, least(100 * pow(2, o_orderkey % 12), 30000)::BIGINT AS ms FROM orders")
def backoff_ceiling(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.backoff_ceiling(F.col("o_orderkey") % 12).alias("ms"))


@query("classify_status", "SELECT o_orderkey, CASE WHEN s BETWEEN 200 AND 299 THEN 'ok' WHEN s = 429 OR s >= 500 THEN 'retry' ELSE 'dead' END AS class FROM (SELECT o_orderkey, [200, 201, 400, 429, 503][(o_orderkey % 5) + 1] AS s FROM orders)")
def classify_status(spark, d):
    status = F.element_at(F.array(*map(F.lit, (200, 201, 400, 429, 503))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", text.status_class(status).alias("class"))
