"""Audit reports as JSON, with a process status that tells loss."""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame

from timberline.operators import audit


def zero_loss(expected: DataFrame, stored: DataFrame, source: str) -> dict:
    """Completeness, span and latency of a source's records."""
    own = stored.where(stored["source"] == source)
    return audit.report(expected, stored, source).first().asDict() | {"latency_ms": audit.latency(own).first().asDict()}


def write(report: dict, path: str | None = None) -> int:
    """Write the report to a file or to standard output; 0 if nothing was lost, else 1."""
    text = json.dumps(report, indent=2, default=str)
    if path:
        with open(path, "w") as f:
            f.write(text + "\n")
    else:
        sys.stdout.write(text + "\n")
    return 0 if report["zero_loss"] else 1
