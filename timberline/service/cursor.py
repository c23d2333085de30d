"""Fingerprints of queries, cursors bound to them, and cache keys."""

from __future__ import annotations

import base64
import hashlib
import json

from timberline.operators.search import InvalidArgument, Query, SortKey


def fingerprint(query: Query) -> str:
    """Short digest of a query's filters, without limit and cursor."""
    times = [t.isoformat() if t else "-" for t in (query.start, query.end)]
    text = "\0".join([query.service, query.host, query.level, query.text, *times])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def encode_cursor(key: SortKey, query: Query) -> str:
    raw = json.dumps({"t": key.ms, "i": key.id, "f": fingerprint(query)}, separators=(",", ":"))
    return base64.urlsafe_b64encode(raw.encode()).decode().rstrip("=")


def decode_cursor(text: str, query: Query) -> SortKey:
    try:
        got = json.loads(base64.urlsafe_b64decode(text + "=" * (-len(text) % 4)))
        key, mark = SortKey(int(got["t"]), str(got["i"])), got["f"]
    except (ValueError, KeyError, TypeError):
        raise InvalidArgument("cursor", "is malformed") from None
    if not key.id:
        raise InvalidArgument("cursor", "is malformed")
    if mark != fingerprint(query):
        raise InvalidArgument("cursor", "was issued for different filters")
    return key


def cache_key(query: Query) -> str:
    after = f"{query.after.ms}:{query.after.id}" if query.after else ""
    return hashlib.sha256(f"{fingerprint(query)}\0{query.limit}\0{after}".encode()).hexdigest()
