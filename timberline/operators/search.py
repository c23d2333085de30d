"""Search: filters, total order, pages with a keyset cursor.

Conditions on columns reach the Parquet scan; a time range also prunes the daily
partitions. Order and cursors work in milliseconds, the resolution of the store.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.functions.levels import LEVELS
from timberline.functions.text import matches

DEFAULT_LIMIT, MAX_LIMIT = 100, 1000
MAX_TERM_BYTES, MAX_QUERY_BYTES = 128, 512


class InvalidArgument(ValueError):
    """A parameter that can't be used; field names it."""

    def __init__(self, field: str, message: str):
        super().__init__(message)
        self.field, self.message = field, message


@dataclass(frozen=True)
class SortKey:
    ms: int
    id: str


@dataclass(frozen=True)
class Query:
    service: str = ""
    host: str = ""
    level: str = ""
    text: str = ""
    start: dt.datetime | None = None
    end: dt.datetime | None = None
    limit: int = DEFAULT_LIMIT
    after: SortKey | None = None


def _time(name: str, value: str) -> dt.datetime | None:
    if not value:
        return None
    try:
        parsed = dt.datetime.fromisoformat(value)
    except ValueError:
        raise InvalidArgument(name, "must be an RFC 3339 time") from None
    if parsed.tzinfo is None or "T" not in value.upper():
        raise InvalidArgument(name, "must be an RFC 3339 time")
    return parsed.astimezone(dt.timezone.utc)


def parse_query(params: dict[str, str]) -> Query:
    """A checked query from request parameters: service, host, level, q, from, to, limit, cursor."""
    from timberline.service.cursor import decode_cursor

    got = {k: (params.get(k) or "").strip() for k in ("service", "host", "level", "q", "from", "to", "limit", "cursor")}
    for name, most in (("service", MAX_TERM_BYTES), ("host", MAX_TERM_BYTES), ("q", MAX_QUERY_BYTES)):
        if len(got[name].encode()) > most:
            raise InvalidArgument(name, f"must have at most {most} bytes")
    level = got["level"].lower()
    if level and level not in LEVELS:
        raise InvalidArgument("level", "is unknown")
    start, end = _time("from", got["from"]), _time("to", got["to"])
    if start and end and start >= end:
        raise InvalidArgument("from", "must lie before to")
    limit = DEFAULT_LIMIT
    if got["limit"]:
        if not got["limit"].lstrip("+-").isdigit() or not 1 <= int(got["limit"]) <= MAX_LIMIT:
            raise InvalidArgument("limit", f"must lie between 1 and {MAX_LIMIT}")
        limit = int(got["limit"])
    query = Query(got["service"], got["host"], level, got["q"], start, end, limit)
    if got["cursor"]:
        query = Query(*(getattr(query, k) for k in ("service", "host", "level", "text", "start", "end", "limit")), decode_cursor(got["cursor"], query))
    return query


def ms(column: str = "timestamp") -> Column:
    return F.unix_millis(column)


def conditions(query: Query, dated: bool = False) -> list[Column]:
    """All of a query's filters; with ``dated``, also those on the partition column event_date."""
    out: list[Column] = []
    for name in ("service", "host", "level"):
        if value := getattr(query, name):
            out.append(F.col(name) == value)
    for bound, compare, day in ((query.start, "__ge__", "__ge__"), (query.end, "__lt__", "__le__")):
        if bound is not None:
            at = F.lit(bound.astimezone(dt.timezone.utc).replace(microsecond=bound.microsecond // 1000 * 1000))
            out.append(getattr(F.col("timestamp"), compare)(at))
            if dated:
                out.append(getattr(F.col("event_date"), day)(F.lit(bound.astimezone(dt.timezone.utc).date())))
    if query.text:
        out.append(matches(F.col("message"), query.text))
    if query.after is not None:
        out.append(after(query.after))
        if dated:
            last = dt.datetime.fromtimestamp(query.after.ms / 1000, dt.timezone.utc).date()
            out.append(F.col("event_date") <= F.lit(last))
    return out


def after(key: SortKey) -> Column:
    """Strictly after a key in falling order, with a bound on the plain column for the scan."""
    bound = F.lit(dt.datetime.fromtimestamp(key.ms // 1000, dt.timezone.utc) + dt.timedelta(seconds=1))
    return (F.col("timestamp") < bound) & ((ms() < key.ms) | ((ms() == key.ms) & (F.col("id") < key.id)))


def matching(logs: DataFrame, query: Query) -> DataFrame:
    dated = "event_date" in logs.columns
    for c in conditions(query, dated):
        logs = logs.where(c)
    return logs


def page(logs: DataFrame, query: Query, more: int = 0) -> DataFrame:
    """The first rows after the cursor in falling order of time and id; ``more`` rows beyond the limit."""
    return matching(logs, query).orderBy(ms().desc(), F.col("id").desc()).limit(query.limit + more)


def fetch(logs: DataFrame, query: Query) -> tuple[list, SortKey | None]:
    """A page's rows, and the key to go on after if there are more."""
    rows = page(logs.withColumn("_ms", ms()), query, more=1).collect()
    rest = len(rows) > query.limit
    rows = rows[: query.limit]
    return rows, SortKey(rows[-1]["_ms"], rows[-1]["id"]) if rest else None


def numbered(logs: DataFrame, size: int) -> DataFrame:
    """Every row with its place and page in the total order."""
    from timberline.operators.ranking import ranked

    out = ranked(logs.withColumn("_ms", ms()), [F.col("_ms").desc(), F.col("id").desc()])
    return out.withColumn("page", F.floor((F.col("place") - 1) / size).cast("bigint"))
