"""Stable identifiers of log records."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_LENGTH = 32


def _eight_bytes(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0"))


def log_id(agent: Column, source: Column, epoch: Column, offset: Column) -> Column:
    """First half of the SHA-256 over length-prefixed agent and source, then epoch and offset."""
    parts = []
    for text in (agent, source):
        parts += [_eight_bytes(F.octet_length(text)), text.cast("binary")]
    parts += [_eight_bytes(epoch), _eight_bytes(offset)]
    return F.substring(F.sha2(F.concat(*parts), 256), 1, ID_LENGTH)


def log_id_value(agent: str, source: str, epoch: int, offset: int) -> str:
    """The same identifier outside Spark."""
    digest = hashlib.sha256()
    for text in (agent.encode(), source.encode()):
        digest.update(len(text).to_bytes(8, "big") + text)
    digest.update(epoch.to_bytes(8, "big") + offset.to_bytes(8, "big"))
    return digest.hexdigest()[:ID_LENGTH]


def valid_log_id(value: Column) -> Column:
    return (F.length(value) == ID_LENGTH) & value.rlike("^[0-9a-f]{32}$")


def index_name(prefix: str, ts: Column) -> Column:
    """Daily index of an event time; the session's time zone has to be UTC."""
    return F.concat(F.lit(prefix + "-"), F.date_format(ts, "yyyy.MM.dd"))
