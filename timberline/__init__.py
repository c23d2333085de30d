"""Timberline: a PySpark-native log analytics engine."""

from __future__ import annotations

import os


def importable(spark) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    A cluster ships the package as usual (``--py-files`` or an image); then this
    only names a folder more.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
