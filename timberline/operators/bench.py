"""Benchmark statistics: percentiles, groups' medians, rank tests."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.operators.percentiles import grouped
from timberline.operators.ranking import running


def nearest_rank(value: str, p: float) -> Column:
    """The smallest value that so many percent of the values don't exceed."""
    return F.expr(f"percentile_disc({p / 100!r}) WITHIN GROUP (ORDER BY {value})")


def summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median, lowest and highest value and number of values of every group."""
    return grouped(df, keys, value, {"median": 0.5}, interpolated=True).select(*keys, "median", "low", "high", F.col("n").alias("runs"))


def rank_sums(df: DataFrame, group: str, value: str) -> DataFrame:
    """group, n and the sum of average ranks over all values of both groups.

    Ranks come from the counts of equal values, so that only different values
    are ordered, by ranges.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_ties"))
    ranks = running(counts, [F.col(value)], "_ties", "_less").select(value, (F.col("_less") + (F.col("_ties") + 1) / 2.0).alias("_rank"))
    return df.join(ranks, value).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("_rank").alias("rank_sum"))


def mann_whitney(df: DataFrame, group: str, value: str, a: str, b: str) -> DataFrame:
    """n and U statistics of two groups: n_a, n_b, u_a, u_b."""
    sums = rank_sums(df.where(F.col(group).isin(a, b)), group, value)
    one = lambda g, c: F.coalesce(F.max(F.when(F.col(group) == g, F.col(c))), F.lit(0))
    wide = sums.agg(one(a, "n").alias("n_a"), one(b, "n").alias("n_b"), one(a, "rank_sum").alias("r_a"))
    u = F.col("r_a") - F.col("n_a") * (F.col("n_a") + 1) / 2.0
    return wide.select("n_a", "n_b", u.alias("u_a"), (F.col("n_a") * F.col("n_b") - u).alias("u_b"))


def mann_whitney_p(a: list[float], b: list[float]) -> float:
    """Two-sided p-value: exact for small samples, the normal approximation with ties beyond."""
    n, m = len(a), len(b)
    both = sorted([*a, *b])
    rank = {x: sum(1 for y in both if y < x) + (sum(1 for y in both if y == x) + 1) / 2 for x in set(both)}
    u = sum(rank[x] for x in a) - n * (n + 1) / 2
    mean = n * m / 2
    if n + m <= 16:
        ranks = [rank[x] for x in both]
        far, total = 0, 0
        for pick in combinations(range(n + m), n):
            total += 1
            far += abs(sum(ranks[i] for i in pick) - n * (n + 1) / 2 - mean) >= abs(u - mean) - 1e-9
        return far / total
    ties = sum((k := both.count(x)) ** 3 - k for x in set(both))
    sigma = math.sqrt(n * m / 12 * (n + m + 1 - ties / ((n + m) * (n + m - 1))))
    z = max(0.0, abs(u - mean) - 0.5) / sigma if sigma else 0.0
    return min(1.0, math.erfc(z / math.sqrt(2)))


def strided(n: int, workers: int, worker: int, offset: int) -> list[int]:
    """Targets of a worker: every ``workers``-th from its own place on."""
    return [(worker + offset + i * workers) % n for i in range(-(-(n - worker) // workers))] if n else []


def nearest_rank_value(ordered: list[float], p: float) -> float:
    """The same percentile of a sorted list; 0 if it is empty."""
    return ordered[max(0, math.ceil(len(ordered) * p / 100) - 1)] if ordered else 0.0
