"""Severity levels: their order, names and the words that stand for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The level names by ordinal, and the words that name a level in log lines.
LEVELS = ("unknown", "trace", "debug", "info", "warn", "error", "fatal")
LEVEL_WORDS = {
    "TRACE": "trace", "TRCE": "trace",
    "DEBUG": "debug", "DBUG": "debug",
    "INFO": "info", "NOTICE": "info",
    "WARN": "warn", "WARNING": "warn",
    "ERROR": "error", "ERR": "error", "SEVERE": "error", "FAIL": "error",
    "FATAL": "fatal", "CRIT": "fatal", "CRITICAL": "fatal", "EMERG": "fatal", "ALERT": "fatal",
}
LEVEL_KEYS = ("level", "severity", "severity_text", "severityText", "lvl", "levelname", "log.level")
LEVEL_TOKENS = 8
TOKEN_TRIM = "[]():,<>"


def literal_map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def level_name(ordinal: Column) -> Column:
    """Name of a level's ordinal; anything out of range is unknown."""
    return F.coalesce(F.try_element_at(literal_map(dict(enumerate(LEVELS))), ordinal.cast("int")), F.lit("unknown"))


def parse_level_name(name: Column) -> Column:
    """Ordinal of a level's name in any case; null for other words."""
    return F.try_element_at(literal_map({x: i for i, x in enumerate(LEVELS)}), F.lower(name))


def json_level(line: Column) -> Column:
    """Level from the first known key of a JSON line that holds a known word; null otherwise."""
    fields = F.from_json(line, "map<string,string>")
    words = literal_map(LEVEL_WORDS)
    found = [F.try_element_at(words, F.upper(F.trim(F.try_element_at(fields, F.lit(k))))) for k in LEVEL_KEYS]
    return F.coalesce(*found)


def token_level(line: Column) -> Column:
    """Level from the first known word among the line's first tokens; null if there is none."""
    tokens = F.slice(F.filter(F.split(line, r"(?U)\s+"), lambda x: x != ""), 1, LEVEL_TOKENS)
    words = literal_map(LEVEL_WORDS)
    levels = F.transform(tokens, lambda x: F.try_element_at(words, F.upper(F.btrim(x, F.lit(TOKEN_TRIM)))))
    return F.try_element_at(F.filter(levels, lambda x: x.isNotNull()), F.lit(1))


def parse_level(line: Column) -> Column:
    """A line's level: its JSON level, else its token level, else unknown."""
    from_json = F.when(F.startswith(line, F.lit("{")), json_level(line))
    return F.coalesce(from_json, token_level(line), F.lit("unknown"))
