"""Completeness audits: what is missing, what is unexpected, spans, rates and latencies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.operators.ranking import running
from timberline.staging import small


def missing(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected ids that no partition of the store has."""
    return expected.select("id").distinct().join(stored.select("id"), "id", "left_anti")


def found(expected: DataFrame, stored: DataFrame) -> DataFrame:
    return expected.select("id").distinct().join(stored.select("id"), "id", "left_semi")


def report(expected: DataFrame, stored: DataFrame, source: str) -> DataFrame:
    """One row: expected, indexed, missing, unexpected, zero_loss, seconds and rate.

    Expected ids are looked up in the whole store, while only rows of the source
    count as indexed.
    """
    ids = expected.select("id").distinct().withColumn("want", F.lit(1))
    have = stored.groupBy("id").agg(
        F.count_if(F.col("source") == source).alias("own"),
        F.min(F.when(F.col("source") == source, F.col("observed_at"))).alias("first"),
        F.max(F.when(F.col("source") == source, F.col("indexed_at"))).alias("last"),
    )
    both = ids.join(have, "id", "full_outer")
    sums = both.agg(
        F.count("want").alias("expected"),
        F.coalesce(F.sum("own"), F.lit(0)).alias("indexed"),
        F.count_if(F.col("want").isNotNull() & F.col("own").isNull()).alias("missing"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    return _summed(sums)


def _summed(sums: DataFrame) -> DataFrame:
    sums = sums.withColumn("unexpected", F.col("indexed") - (F.col("expected") - F.col("missing")))
    seconds = (F.unix_micros("last") - F.unix_micros("first")) / 1e6
    return sums.select(
        "expected", "indexed", "missing", "unexpected", ((F.col("missing") == 0) & (F.col("unexpected") <= 0)).alias("zero_loss"),
        seconds.alias("seconds"), F.when(seconds > 0, (F.col("indexed") - F.col("unexpected")) / seconds).alias("rate"),
    )


#: Bits of an id's hash that name its bucket, level by level.
LEVELS = (12, 24)


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("id"), 64 - bits).alias("bucket")


def digests(rows: DataFrame, bits: int) -> DataFrame:
    """For every bucket of ids: their number, and digests that no order of them changes."""
    h, other = F.xxhash64("id"), F.xxhash64("id", F.lit(1))
    return rows.groupBy(_bucket(bits)).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(other).alias("y"), F.sum(other.bitwiseAND((1 << 31) - 1)).alias("s"))


def differing(expected: DataFrame, stored: DataFrame, levels: tuple[int, ...] = LEVELS) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose buckets of ids differ; all others hold the same ids on both sides, equally often.

    Each level shuffles digests only, of buckets that differed on the level
    before, so that what is compared id by id in the end is in proportion to what differs.
    """
    sides = [expected, stored]
    for bits in levels:
        a, b = (digests(x.select("id"), bits) for x in sides)
        same = [a[c].eqNullSafe(b[c]) for c in ("n", "x", "y", "s")]
        buckets = a.join(b, a["bucket"] == b["bucket"], "full_outer").where(~reduce(Column.__and__, same)).select(F.coalesce(a["bucket"], b["bucket"]).alias("__bucket"))
        buckets = small(buckets, "buckets")
        sides = [x.join(buckets, _bucket(bits) == buckets["__bucket"], "left_semi") for x in sides]
    return sides[0], sides[1]


def report_by_digests(expected: DataFrame, stored: DataFrame, source: str, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``report`` of expected ids that are distinct, as those of a file's lines are; only buckets that differ are looked up by id."""
    few, there = differing(expected, stored, levels)
    gone = missing(few, there).agg(F.count(F.lit(1)).alias("missing"))
    own = stored.where(F.col("source") == source).agg(F.count(F.lit(1)).alias("indexed"), F.min("observed_at").alias("first"), F.max("indexed_at").alias("last"))
    sums = expected.agg(F.count("id").alias("expected")).join(F.broadcast(own)).join(F.broadcast(gone))  # one row each
    return _summed(sums)


def percentiles(df: DataFrame, value: str, points: dict[str, float], largest: str) -> DataFrame:
    """One row of exact interpolated percentiles (name: share of the values) and the largest value.

    Different values are counted, dealt by ranges and summed up, so that no task
    holds all of them, as the built-in aggregate does.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    rows = running(counts, [F.col(value)], "_n", "_before")
    total = rows.agg(F.sum("_n").alias("_total"))
    rows = rows.join(F.broadcast(total))
    at = lambda rank: F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")), F.col(value)))
    ranks = {k: (F.col("_total") - 1) * F.lit(p) for k, p in points.items()}
    ends = rows.agg(
        *(at(f(r)).alias(f"_{k}_{n}") for k, r in ranks.items() for n, f in (("low", F.floor), ("high", F.ceil))),
        *(F.max(r - F.floor(r)).alias(f"_{k}_part") for k, r in ranks.items()), F.max(value).alias(largest),
    )
    return ends.select(*((F.col(f"_{k}_low") + (F.col(f"_{k}_high") - F.col(f"_{k}_low")) * F.col(f"_{k}_part")).alias(k) for k in points), largest)


def latency(stored: DataFrame, exact: bool = True, accuracy: int = 1000) -> DataFrame:
    """Milliseconds from reading to indexing: p50, p90, p99 and max."""
    x = stored.select(((F.unix_micros("indexed_at") - F.unix_micros("observed_at")) / 1000.0).alias("ms"))
    points = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    if exact:
        return percentiles(x, "ms", points, "max_ms")
    q = F.percentile_approx("ms", list(points.values()), accuracy)
    return x.agg(q.alias("q"), F.max("ms").alias("max_ms")).select(*(F.col("q")[i].alias(k) for i, k in enumerate(points)), "max_ms")


def redundant_writes(writes: DataFrame) -> DataFrame:
    """Writes that the store absorbed because it had the id already."""
    return writes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("writes"), F.count(F.lit(1)).alias("documents"), (F.sum("n") - F.count(F.lit(1))).alias("redundant"))
