"""Ordered state: contiguous acknowledgement, epochs of a file, token buckets, stalls."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contiguous_prefix(df: DataFrame, keys: list[str], seq: str, acked: str) -> DataFrame:
    """keys and the last sequence number up to which everything is acknowledged; null if the first isn't.

    The first gap is a minimum, so no rows are brought together in order.
    """
    gap = df.groupBy(*keys).agg(F.min(F.when(~F.col(acked), F.col(seq))).alias("_gap"))
    rows = df.join(gap, keys)
    return rows.groupBy(*keys).agg(F.max(F.when(F.col("_gap").isNull() | (F.col(seq) < F.col("_gap")), F.col(seq))).alias("cursor"))


def epochs(df: DataFrame, path: str, order: str, size: str, inode: str, chunk: int = 100_000) -> DataFrame:
    """Adds epoch: how often the file at a path was truncated or replaced so far.

    A path's readings are cut into chunks of ``order``, a number, so that a long
    history needs no single task: a chunk's first reading is compared with the last
    one of the chunk before, and epochs of the chunks before are added up, of both
    of which there is one row a chunk.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    last = rows.groupBy(path, "_chunk").agg(F.max_by(F.struct(F.col(size).alias("size"), F.col(inode).alias("inode")), order).alias("_last"))
    carried = last.select(path, "_chunk", F.lag("_last").over(Window.partitionBy(path).orderBy("_chunk")).alias("_carried"))
    of = Window.partitionBy(path, "_chunk").orderBy(order)
    first = F.row_number().over(of) == 1
    before = lambda c, n: F.when(first, F.col(f"_carried.{n}")).otherwise(F.lag(c).over(of))
    rows = rows.join(carried, [path, "_chunk"]).withColumns({"_size": before(size, "size"), "_inode": before(inode, "inode")})
    broken = F.coalesce((F.col(size) < F.col("_size")) | (F.col(inode) != F.col("_inode")), F.lit(False)).cast("bigint")
    rows = rows.withColumn("_new", broken)
    sums = rows.groupBy(path, "_chunk").agg(F.sum("_new").alias("_sum"))
    earlier = Window.partitionBy(path).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(path, "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    inside = F.sum("_new").over(of.rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(sums, [path, "_chunk"]).withColumn("epoch", F.col("_earlier") + inside).select(*df.columns, "epoch")


def token_bucket(df: DataFrame, key: str, order: str, at_ms: str, rate: float, burst: int, cost: Column | None = None) -> DataFrame:
    """key, order, allowed and wait_ms of every request, by a bucket of ``burst`` tokens that refills at ``rate`` a second.

    Requests of a key come in order to one task, which holds no more than the
    bucket's state; costs lie between 1 and the burst.
    """
    cost = F.greatest(F.lit(1.0), F.least(cost if cost is not None else F.lit(1.0), F.lit(float(burst))))
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, order)}

    def run(batches):
        import pyarrow as pa

        owner, left, last = object(), 0.0, 0
        for batch in batches:
            allowed, waits = [], []
            for k, t, c in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if k != owner:
                    owner, left, last = k, float(burst), t
                left = min(float(burst), left + max(t - last, 0) * (rate / 1000))
                last = t
                ok = left >= c
                waits.append(0 if ok else math.ceil((c - left) * (1000 / rate)))
                left -= c if ok else 0.0
                allowed.append(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(allowed, pa.bool_()), pa.array(waits, pa.int64())], names=[key, order, "allowed", "wait_ms"])

    rows = df.select(key, order, F.col(at_ms).cast("bigint").alias("_t"), cost.cast("double").alias("_c"))
    return rows.repartition(key).sortWithinPartitions(key, "_t", order).mapInArrow(run, f"{key} {kinds[key]}, {order} {kinds[order]}, allowed boolean, wait_ms bigint")


def stalled_at(df: DataFrame, order: str, count: str, stall: int) -> DataFrame:
    """The first reading at which the count has stayed the same for ``stall`` seconds; order holds epoch seconds."""
    since = df.groupBy(count).agg(F.min(order).alias("since"))
    held = df.join(since, count).where(F.col(order) - F.col("since") >= stall)
    return held.agg(F.min(order).alias("stalled_at"))
