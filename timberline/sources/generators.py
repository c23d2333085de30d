"""Generators: replay of lines in a loop, and bursts of errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.operators.ranking import ranked


def replay(spark: SparkSession, lines: DataFrame, column: str, order: list[str], count: int) -> DataFrame:
    """seq and line of ``count`` lines: the given ones over and over, without blank ones and trailing carriage returns."""
    kept = lines.withColumn("line", F.regexp_replace(column, r"\r+\z", "")).where("line <> ''")
    table = ranked(kept.select(*order, "line"), [F.col(c) for c in order]).select((F.col("place") - 1).alias("i"), "line")
    size = table.count()
    if not size:
        return spark.createDataFrame([], "seq long, line string")
    return spark.range(count).select(F.col("id").alias("seq"), (F.col("id") % size).alias("i")).join(table, "i").select("seq", "line")


def burst(spark: SparkSession, count: int) -> DataFrame:
    """seq and line of error lines, one a second."""
    i = F.col("id")
    clock = F.lpad((F.lit(200000) + F.floor(i / 60) % 60 * 100 + i % 60).cast("string"), 6, "0")
    line = F.concat(F.lit("081109 "), clock, F.lit(" "), i + 100, F.lit(" ERROR dfs.DataNode$PacketResponder: block blk_"), i, F.lit(" failed"))
    return spark.range(count).select(i.alias("seq"), line.alias("line"))


def paced(spark: SparkSession, lines: DataFrame, per_second: int) -> DataFrame:
    """A stream of lines at a fixed rate, looped; ``lines`` has i (from 0) and line."""
    size = lines.count()
    stream = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return stream.select("timestamp", "value", (F.col("value") % size).alias("i")).join(lines, "i").select("timestamp", "value", "line")
