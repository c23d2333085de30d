"""All registered log queries and their SQL oracles."""

from __future__ import annotations

from timberline.plans import extraction, observing, storing  # noqa: F401
from timberline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
