"""API keys: which service a presented key stands for. Only digests are kept."""

from __future__ import annotations

import hashlib
import hmac
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeyMap:
    digests: dict[str, str]

    @classmethod
    def parse(cls, text: str) -> KeyMap:
        """From ``key:service`` pairs between commas; errors never show a key."""
        out: dict[str, str] = {}
        for i, pair in enumerate(x for x in text.split(",") if x.strip()):
            key, _, service = (x.strip() for x in pair.partition(":"))
            if not key or not service:
                raise ValueError(f"pair {i + 1} lacks a key or a service")
            digest = hashlib.sha256(key.encode()).hexdigest()
            if digest in out:
                raise ValueError(f"pair {i + 1} repeats a key")
            out[digest] = service
        return cls(out)

    def service(self, key: str) -> str | None:
        digest = hashlib.sha256(key.encode()).hexdigest()
        return next((s for d, s in self.digests.items() if hmac.compare_digest(d, digest)), None)

    def service_column(self, key: Column) -> Column:
        """Service of a key's digest; null for unknown keys."""
        table = F.create_map(*(F.lit(x) for kv in self.digests.items() for x in kv))
        return F.try_element_at(table, F.sha2(key, 256))
