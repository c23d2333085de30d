"""Metric samples: histograms, quantiles, counter rates, deltas between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exponential_bounds(start: float, factor: float, count: int) -> list[float]:
    return [start * factor**i for i in range(count)]


def cumulative_histogram(df: DataFrame, keys: list[str], value: str, bounds: list[float]) -> DataFrame:
    """keys, le (text, +Inf last) and the number of values up to each bound, one aggregation over the rows."""
    counts = [F.count_if(F.col(value) <= b).alias(f"_{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*keys).agg(*counts, F.count(F.col(value)).alias("_inf"))
    rows = [F.struct(F.lit(i).alias("k"), F.lit(b).cast("double").alias("bound"), F.col(f"_{i}").alias("count")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(len(bounds)).alias("k"), F.lit(float("inf")).alias("bound"), F.col("_inf").alias("count")))
    return wide.select(*keys, F.explode(F.array(*rows)).alias("b")).select(*keys, "b.k", "b.bound", "b.count")


def histogram_quantile(histogram: DataFrame, keys: list[str], q: float) -> DataFrame:
    """keys and the value at quantile q, linear inside its bucket; the last finite bound beyond it, NaN without samples."""
    per = histogram.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bound", "count"))).alias("b"))
    total = F.element_at("b", -1)["count"]
    rank = F.lit(q) * total
    expr = """
      CASE WHEN total IS NULL OR total <= 0 THEN CAST('NaN' AS DOUBLE) ELSE (
        transform(array(array_position(transform(b, x -> x.count >= rank), true)), i ->
          CASE WHEN b[int(i) - 1].bound = CAST('Infinity' AS DOUBLE) THEN IF(i > 1, b[int(i) - 2].bound, CAST('NaN' AS DOUBLE))
               ELSE IF(i > 1, b[int(i) - 2].bound, 0D) + (b[int(i) - 1].bound - IF(i > 1, b[int(i) - 2].bound, 0D))
                    * IF(b[int(i) - 1].count = IF(i > 1, b[int(i) - 2].count, 0), 0D, (rank - IF(i > 1, b[int(i) - 2].count, 0)) / (b[int(i) - 1].count - IF(i > 1, b[int(i) - 2].count, 0)))
          END)[0]) END"""
    return per.withColumn("total", total).withColumn("rank", rank.cast("double")).select(*keys, F.expr(expr).alias("value"))


def increases(samples: DataFrame, keys: list[str], at: str, value: str, ties: list[str] = [], chunk: int = 86_400) -> DataFrame:  # noqa: B006
    """Adds _up: the counter's growth since the series' sample before; a drop is a restart from 0, the first sample counts 0.

    A series is cut into chunks of time, so that a long one needs no single task:
    a chunk's first sample is compared with the last one of the chunk before, of
    which there is one row a chunk.
    """
    rows = samples.withColumn("_chunk", F.floor(F.col(at) / chunk))
    order = [at, *ties]
    last = rows.groupBy(*keys, "_chunk").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    carried = last.select(*keys, "_chunk", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carried"))
    before = F.coalesce(F.lag(value).over(Window.partitionBy(*keys, "_chunk").orderBy(*order)), F.col("_carried"))
    grown = F.when(before.isNull(), F.lit(0)).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    return rows.join(carried, [*keys, "_chunk"]).withColumn("_up", grown).drop("_chunk", "_carried")


def counter_rate(samples: DataFrame, keys: list[str], at: str, value: str, width: int, step: int, ties: list[str] = []) -> DataFrame:  # noqa: B006
    """keys, tick and the counter's increase a second over the last ``width`` seconds, every ``step`` seconds.

    ``at`` holds epoch seconds, ``ties`` orders samples of one second.
    """
    return rate_of(increases(samples, keys, at, value, ties), keys, at, "_up", width, step)


def snapshot_delta(after: DataFrame, before: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys and after - before; what the first snapshot lacks counts as 0."""
    b = before.select(*keys, F.col(value).alias("_before"))
    return after.join(b, keys, "left").select(*keys, (F.col(value) - F.coalesce("_before", F.lit(0))).alias("delta"))


def sum_by(samples: DataFrame, labels: list[str], value: str) -> DataFrame:
    return samples.groupBy(*labels).agg(F.sum(value).alias("total"))


def clamped_ms(later: Column, earlier: Column) -> Column:
    """Milliseconds between two times, none below 0."""
    return F.greatest((F.unix_micros(later) - F.unix_micros(earlier)) / 1000.0, F.lit(0.0))


def rate_of(increases: DataFrame, keys: list[str], at: str, up: str, width: int, step: int) -> DataFrame:
    """keys, tick and increases a second over the last ``width`` seconds, every ``step`` seconds.

    Increases are summed up by the first tick that sees them, and only these sums
    are repeated for the ticks after it. Where ``step`` doesn't divide ``width``,
    increases that the last tick no longer sees are summed apart.
    """
    first = (F.ceil(F.col(at) / step) * step).cast("bigint")
    span = (F.floor((width - 1 - (first - F.col(at))) / step) * step).cast("bigint")  # from the first tick to the last
    sums = increases.withColumns({"_first": first, "_span": span}).where("_span >= 0").groupBy(*keys, "_first", "_span").agg(F.sum(up).alias("_sum"))
    ticks = sums.withColumn("tick", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_span"), F.lit(step).cast("bigint"))))
    return ticks.groupBy(*keys, "tick").agg((F.sum("_sum") / float(width)).alias("rate"))
