"""Percentiles of groups: exact ones without holding a group's values in one task, and mergeable sketches for repeated questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.operators.ranking import running
from timberline.staging import small


def grouped(df: DataFrame, keys: list[str], value: str, points: dict[str, float], interpolated: bool = False) -> DataFrame:
    """keys, one column for each point (name: share of the values), low, high and n of every group.

    A point is the smallest value that its share of the values doesn't exceed,
    or, if ``interpolated``, lies between the values beside it. Different values
    are counted first; they are dealt by ranges of the order of keys and values
    and numbered there, so that a hot group is many tasks. Nulls are left out,
    as is a group of nothing else; a null key is a group.
    """
    counts = df.where(F.col(value).isNotNull()).select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(value).alias("__v"))
    own = [f"__k{i}" for i in range(len(keys))]
    counts = counts.groupBy(*own, "__v").agg(F.count(F.lit(1)).alias("__n"))
    rows = running(counts, [*map(F.col, own), F.col("__v")], "__n", "__less")
    groups = rows.groupBy(*own).agg(F.min("__less").alias("__start"), F.sum("__n").alias("__total"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    groups = small(groups.select(*(F.col(k).alias(f"{k}g") for k in own), "__start", "__total", "__low", "__high"), "groups")
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"{k}g")) for k in own), F.lit(True))
    if interpolated:
        ranks = {k: (F.col("__total") - 1) * F.lit(p) for k, p in points.items()}
        ends = {(k, e): f(r) for k, r in ranks.items() for e, f in (("low", F.floor), ("high", F.ceil))}
    else:
        ends = {(k, "low"): F.greatest(F.ceil(F.col("__total") * F.lit(p)) - 1, F.lit(0)) for k, p in points.items()}
    at = F.col("__less") - F.col("__start")
    hit = {e: (at <= rank) & (rank < at + F.col("__n")) for e, rank in ends.items()}
    found = rows.join(groups, same).where(reduce(Column.__or__, hit.values()))
    by = found.groupBy(*own, "__total", "__low", "__high").agg(*(F.max(F.when(x, F.col("__v"))).alias(f"__{k}_{e}") for (k, e), x in hit.items()))
    low = lambda k: F.col(f"__{k}_low")
    out = {k: low(k) + (F.col(f"__{k}_high") - low(k)) * (ranks[k] - F.floor(ranks[k])) if interpolated else low(k) for k in points}
    return by.select(*(F.col(k).alias(name) for k, name in zip(own, keys)), *(c.alias(k) for k, c in out.items()), F.col("__low").alias("low"), F.col("__high").alias("high"), F.col("__total").alias("n"))


def sketches(df: DataFrame, keys: list[str], value: str, k: int = 800) -> DataFrame:
    """keys and a KLL sketch of every group's values, to be written once, as by day and service."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return parts.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def estimated(parts: DataFrame, points: dict[str, float]) -> DataFrame:
    """Percentiles that sketches estimate, in place of the sketches; with k of 800 their ranks are off by half a percent or so."""
    return parts.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for name, p in points.items()}).drop("sketch")
