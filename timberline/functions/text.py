"""Text helpers: container lines, search terms, samples and messages for chat."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_BYTES = 200
TERM = r"[\p{L}\p{N}_]+(?:(?:[.:'](?=\p{L})|[.,](?=\p{N}))[\p{L}\p{N}_]+)*"


def terms(text: Column) -> Column:
    """Lower-cased search terms: words, joined by dots, colons or apostrophes inside."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def matches(text: Column, query: str) -> Column:
    """Whether every term of the query is a term of the text; a query without terms matches nothing.

    Texts that don't contain the query's longest runs of ASCII letters and digits
    are told apart first, so that terms are taken of few texts only.
    """
    wanted = F.array_distinct(terms(F.lit(query)))
    exact = (F.size(wanted) > 0) & (F.size(F.array_except(wanted, terms(text))) == 0)
    runs = sorted({x.lower() for x in re.findall(r"[A-Za-z0-9]+", query)} , key=lambda x: (-len(x), x))[:4]
    for run in reversed(runs):
        exact = F.contains(F.lower(text), F.lit(run)) & exact
    return exact


def contains_ci(text: Column, part: str) -> Column:
    return F.contains(F.lower(text), F.lit(part.lower()))


def container_json(line: Column) -> Column:
    """Struct of log, stream and time of a container runtime's JSON line; null if it is none."""
    return F.from_json(F.when(F.startswith(F.ltrim(line), F.lit("{")), line), "log string, stream string, time string")


def unwrapped(rows: DataFrame, line: Column, out: str) -> DataFrame:
    """Adds ``out``, the struct of ``unwrap_container_line``; each line is parsed once, however often its parts are used.

    A generator stands between parsing and use, through which the optimizer
    doesn't push either.
    """
    parsed = rows.withColumn("_line", line).withColumn("_json", F.explode(F.array(container_json(F.col("_line")))))
    return parsed.withColumn(out, F.explode(F.array(unwrap_container_line(F.col("_line"), F.col("_json"))))).drop("_line", "_json")


def unwrap_container_line(line: Column, parsed: Column | None = None) -> Column:
    """Struct of ok, message, time and drop for a container runtime's JSON line.

    Not ok: no JSON, or neither text nor time; the line is plain text then. An
    empty message of a proper line is to be dropped.
    """
    x = container_json(line) if parsed is None else parsed
    text, time = F.coalesce(x["log"], F.lit("")), F.coalesce(x["time"], F.lit(""))
    ok = F.coalesce((text != "") | (time != ""), F.lit(False))
    message = F.when(ok, F.regexp_replace(text, r"[\r\n]+\z", "")).otherwise(line)
    from timberline.functions.timestamps import rfc3339

    return F.struct(ok.alias("ok"), message.alias("message"), F.when(ok, rfc3339(time)).alias("time"), (ok & (message == "")).alias("drop"))


def short_container_id(path: Column) -> Column:
    """First twelve characters of the folder's name that holds a container's log."""
    return F.left(F.element_at(F.split(path, "/"), -2), F.lit(12))


def escape_chat(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def truncated(text: Column, size: int = SAMPLE_BYTES) -> Column:
    """The first bytes of a long text and three dots, as binary so that a cut character stays cut; shorter texts as they are."""
    data = text.cast("binary")
    return F.when(F.octet_length(text) > size, F.concat(F.substring(data, 1, size), F.lit("...").cast("binary"))).otherwise(data)


def backoff_ceiling(attempt: Column, base_ms: int = 100, max_ms: int = 30_000) -> Column:
    return F.least(F.lit(float(base_ms)) * F.pow(F.lit(2.0), attempt), F.lit(float(max_ms))).cast("bigint")


def status_class(status: Column) -> Column:
    """ok, retry or dead for the status of one bulk item."""
    return F.when(status.between(200, 299), "ok").when((status == 429) | (status >= 500), "retry").otherwise("dead")
