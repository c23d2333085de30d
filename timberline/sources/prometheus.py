"""Readers of metric texts: the Prometheus exposition format and container statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = r"^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+\d+)?$"
LABEL = r'([a-zA-Z_][a-zA-Z0-9_]*)="((?:[^"\\]|\\.)*)"'


def parse_samples(lines: DataFrame, column: str = "value") -> DataFrame:
    """name, labels and value of every sample line; comments and other lines are left out."""
    text = F.col(column)
    rows = lines.where(text.rlike(SAMPLE)).select(*(F.regexp_extract(text, SAMPLE, i).alias(c) for i, c in ((1, "name"), (2, "l"), (3, "v"))))
    pairs = F.arrays_zip(F.regexp_extract_all("l", F.lit(LABEL), F.lit(1)).alias("k"), F.regexp_extract_all("l", F.lit(LABEL), F.lit(2)).alias("x"))
    number = F.when(F.lower("v") == "+inf", F.lit(float("inf"))).when(F.lower("v") == "-inf", F.lit(float("-inf"))).otherwise(F.expr("try_cast(v AS DOUBLE)"))
    return rows.select("name", F.map_from_entries(pairs).alias("labels"), number.alias("value"))


def total(samples: DataFrame, name: str, **labels: str) -> float:
    """Sum of a metric over the series with these labels; an error if there are none."""
    rows = samples.where(F.col("name") == name)
    for k, v in labels.items():
        rows = rows.where(F.col("labels")[k] == v)
    got = rows.agg(F.sum("value"), F.count("*")).first()
    if not got[1]:
        raise LookupError(f"no series of {name} with {labels}")
    return got[0]


def parse_stats(lines: DataFrame, column: str = "value") -> DataFrame:
    """container and cpu (percent) of lines such as ``name cpu=12.5%``."""
    pattern = r"^(\S+)\s.*?cpu=([0-9.]+)%"
    rows = lines.where(F.col(column).rlike(pattern))
    return rows.select(F.regexp_extract(column, pattern, 1).alias("container"), F.regexp_extract(column, pattern, 2).cast("double").alias("cpu"))
