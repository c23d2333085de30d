"""Settings from the environment; all errors are reported together."""

from __future__ import annotations

import os
import re

UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


class Settings:
    def __init__(self, env: dict[str, str] | None = None):
        self.env, self.errors = os.environ if env is None else env, []

    def _get(self, name: str, default, convert, kind: str):
        raw = (self.env.get(name) or "").strip()
        if not raw:
            if default is None:
                self.errors.append(f"{name} is required")
            return default
        try:
            return convert(raw)
        except ValueError:
            self.errors.append(f"{name} is no {kind}")
            return default

    def text(self, name: str, default: str | None = None) -> str | None:
        return self._get(name, default, str, "text")

    def items(self, name: str, default: list[str] | None = None) -> list[str] | None:
        return self._get(name, default, lambda x: [p.strip() for p in x.split(",") if p.strip()], "list")

    def integer(self, name: str, default: int | None = None) -> int | None:
        return self._get(name, default, int, "whole number")

    def number(self, name: str, default: float | None = None) -> float | None:
        return self._get(name, default, float, "number")

    def seconds(self, name: str, default: float | None = None) -> float | None:
        def convert(x: str) -> float:
            parts = re.findall(r"(\d+(?:\.\d+)?)(ms|s|m|h)", x)
            if "".join(a + b for a, b in parts) != x:
                raise ValueError
            return sum(float(a) * UNITS[b] for a, b in parts)

        return self._get(name, default, convert, "duration")

    def check(self) -> None:
        if self.errors:
            raise ValueError("; ".join(self.errors))
