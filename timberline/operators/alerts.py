"""Error spikes: windowed counts against a trailing baseline, and a state machine per service."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timberline.staging import written

ALERT_LEVELS = ("error", "fatal")


@dataclass(frozen=True)
class Rule:
    """Lengths in buckets; bucket in microseconds."""

    window: int = 6
    baseline: int = 48
    min_errors: int = 5
    ratio: float = 1.5
    cooldown: int = 12
    bucket: int = 3_600_000_000
    samples: int = 3


def bucket_of(column: str | Column, rule: Rule) -> Column:
    at = F.unix_micros(column if isinstance(column, Column) else F.col(column))
    return F.floor(at / F.lit(rule.bucket)).cast("bigint")


def error_buckets(logs: DataFrame, rule: Rule, now: Column | None = None) -> DataFrame:
    """service, bucket and number of errors by arrival time; a time beyond ``now`` counts as now, one past the look-back not at all."""
    at = F.col("observed_at")
    rows = logs.where(F.col("level").isin(*ALERT_LEVELS))
    if now is not None:
        at = F.least(F.coalesce(at, now), now)
        rows = rows.where(bucket_of(at, rule) > bucket_of(now, rule) - rule.window - rule.baseline)
    return rows.groupBy("service", bucket_of(at, rule).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def ticks(buckets: DataFrame, rule: Rule) -> DataFrame:
    """A row for every service and every bucket up to the newest one that has an error in its look-back.

    In all others nothing can happen: a window is empty there and so is its
    baseline. A stray time makes no more rows than window and baseline have buckets.
    """
    newest = buckets.agg(F.max("bucket").alias("newest"))
    last = F.least(F.col("bucket") + (rule.window + rule.baseline - 1), F.col("newest"))
    spine = buckets.join(F.broadcast(newest)).select("service", F.explode(F.sequence("bucket", last)).alias("bucket")).distinct()
    return spine.join(buckets, ["service", "bucket"], "left").fillna(0, ["n"])


#: Buckets of a service that one task evaluates together; more if the look-back is longer.
CHUNK = 4096


def chunked(buckets: DataFrame, rule: Rule, chunk: int = CHUNK) -> DataFrame:
    """service, chunk, bucket, win (errors in the window) and usual (baseline errors scaled to the window's length).

    A service's time is cut into chunks. Buckets within the look-back of a chunk's
    first ones go along with it, so that every chunk is evaluated for itself. There
    is a row for every bucket of ``ticks``.
    """
    reach = rule.window + rule.baseline - 1
    size = max(chunk, reach + 1)
    newest = buckets.agg(F.max("bucket").alias("newest"))
    first = lambda c: F.floor(c / size).cast("bigint")
    rows = buckets.withColumn("chunk", F.explode(F.sequence(first(F.col("bucket")), first(F.col("bucket") + reach)))).join(F.broadcast(newest))
    start = F.greatest("bucket", F.col("chunk") * size)
    last = F.least(F.col("bucket") + reach, F.col("newest"), (F.col("chunk") + 1) * size - 1)
    spine = rows.where(start <= last).select("service", "chunk", F.explode(F.sequence(start, last)).alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    all_ = spine.distinct().unionByName(rows.select("service", "chunk", "bucket", F.col("n").cast("bigint"))).groupBy("service", "chunk", "bucket").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("service", "chunk").orderBy("bucket")
    win = F.sum("n").over(of.rangeBetween(-(rule.window - 1), 0))
    base = F.coalesce(F.sum("n").over(of.rangeBetween(-reach, -rule.window)), F.lit(0))
    out = all_.select("service", "chunk", "bucket", win.alias("win"), (base * rule.window / float(rule.baseline)).alias("usual"))
    return out.where(F.col("bucket") >= F.col("chunk") * size)


def windowed(buckets: DataFrame, rule: Rule, chunk: int = CHUNK) -> DataFrame:
    """service, bucket, win and usual of every tick."""
    return chunked(buckets, rule, chunk).drop("chunk")


def spiking(rule: Rule) -> Column:
    return (F.col("win") >= rule.min_errors) & (F.col("win") >= rule.ratio * F.greatest(F.col("usual"), F.lit(1.0)))


class Summary:
    """What a chunk of ticks does to a service's state, whatever that is when the chunk begins.

    A state is whether the alert fires, and the bucket from which it may fire
    again. Once the first firing of a chunk is known nothing before it matters, so
    the chunk is a table: for each spike that may be the first to fire, the state at
    the chunk's end; and the first calm bucket, up to which a firing alert goes on.
    """

    @staticmethod
    def of(bucket: list[int], spike: list[bool], calm: list[bool], ready_by: int, cooldown: int) -> tuple[int | None, list[tuple[int, bool, int]]]:
        """First calm bucket, and (bucket, firing at the end, ready again) of the spikes that can be the first; a state is ready by ``ready_by`` at the latest."""
        n = len(bucket)
        calm_at = next((b for b, c in zip(bucket, calm) if c), None)
        ends: list[tuple[bool, int] | None] = [None] * n
        next_calm, spikes = None, []  # of what comes behind; spikes from the last to the first
        for i in range(n - 1, -1, -1):
            if calm[i]:
                next_calm = i
            elif spike[i]:
                ready = bucket[i] + cooldown
                if next_calm is None:
                    ends[i] = True, ready
                else:
                    lo, hi = 0, len(spikes)  # spikes behind the calm bucket from which it may fire again: a prefix of the list
                    while lo < hi:
                        mid = (lo + hi) // 2
                        lo, hi = (mid + 1, hi) if bucket[spikes[mid]] >= max(ready, bucket[next_calm] + 1) else (lo, mid)
                    ends[i] = ends[spikes[lo - 1]] if lo else (False, ready)
                spikes.append(i)
        table = []
        for i in reversed(spikes):
            table.append((bucket[i], *ends[i]))
            if bucket[i] >= ready_by and (calm_at is None or bucket[i] > calm_at):
                break
        return calm_at, table

    @staticmethod
    def after(calm_at: int | None, table: list[tuple[int, bool, int]], on: bool, ready: int) -> tuple[bool, int]:
        """The state at the chunk's end if it is (on, ready) at its beginning."""
        if on and calm_at is None:
            return on, ready
        start = max(ready, calm_at + 1) if on else ready
        return next(((fires, again) for at, fires, again in table if at >= start), (False, ready))


def transitions(buckets: DataFrame, rule: Rule, chunk: int = CHUNK) -> DataFrame:
    """service, bucket, kind (firing or resolved), errors and usual of every transition.

    Chunks are summed up side by side; a service's summaries, a few numbers for
    each chunk, are gone through in order; then every chunk, its first state
    known, is evaluated for itself.
    """
    import pyarrow as pa

    never = -(1 << 62)
    size = max(chunk, rule.window + rule.baseline)
    rows = chunked(buckets, rule, chunk).withColumns({"spike": spiking(rule), "calm": 2 * F.col("win") < rule.min_errors})
    rows = written(rows.where("spike OR calm"), "ticks")

    def summed(x: pa.Table) -> pa.Table:
        service, at, *columns = x.sort_by("bucket").to_pydict().values()
        calm_at, table = Summary.of(*columns, at[0] * size + rule.cooldown, rule.cooldown)
        return pa.Table.from_pylist([{"service": service[0], "chunk": at[0], "calm_at": calm_at, "spikes": [t[0] for t in table], "fires": [t[1] for t in table], "again": [t[2] for t in table]}], schema=summary)

    def states(x: pa.Table) -> pa.Table:
        on, ready, out = False, never, []
        for r in x.sort_by("chunk").to_pylist():
            out.append({"service": r["service"], "chunk": r["chunk"], "on": on, "ready": ready})
            on, ready = Summary.after(r["calm_at"], list(zip(r["spikes"], r["fires"], r["again"])), on, ready)
        return pa.Table.from_pylist(out, schema=state)

    def evaluated(x: pa.Table) -> pa.Table:
        out, on, ready = [], x["on"][0].as_py(), x["ready"][0].as_py()
        for r in x.sort_by("bucket").to_pylist():
            if not on and r["spike"] and r["bucket"] >= ready:
                on, ready = True, r["bucket"] + rule.cooldown
            elif on and r["calm"]:
                on = False
            else:
                continue
            out.append({"service": r["service"], "bucket": r["bucket"], "kind": "firing" if on else "resolved", "errors": r["win"], "usual": r["usual"]})
        return pa.Table.from_pylist(out, schema=result)

    text, number, flag = pa.string(), pa.int64(), pa.bool_()
    summary = pa.schema({"service": text, "chunk": number, "calm_at": number, "spikes": pa.list_(number), "fires": pa.list_(flag), "again": pa.list_(number)})
    state = pa.schema({"service": text, "chunk": number, "on": flag, "ready": number})
    result = pa.schema({"service": text, "bucket": number, "kind": text, "errors": number, "usual": pa.float64()})
    summaries = rows.select("service", "chunk", "bucket", "spike", "calm").groupBy("service", "chunk").applyInArrow(summed, "service string, chunk long, calm_at long, spikes array<long>, fires array<boolean>, again array<long>")
    first = summaries.groupBy("service").applyInArrow(states, "service string, chunk long, on boolean, ready long")
    known = rows.join(first, ["service", "chunk"]).groupBy("service", "chunk")
    return known.applyInArrow(evaluated, "service string, bucket long, kind string, errors long, usual double")


def samples(logs: DataFrame, rule: Rule) -> DataFrame:
    """The last error messages of each service by arrival: service, rank and message.

    A first cut inside hashed parts of a service keeps the rows of one service
    from meeting in one task.
    """
    rows = logs.where(F.col("level").isin(*ALERT_LEVELS)).select("service", "observed_at", "id", "message", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part"))
    order = [F.col("observed_at").desc(), F.col("id").desc()]
    part = rows.withColumn("r", F.row_number().over(Window.partitionBy("service", "part").orderBy(*order))).where(F.col("r") <= rule.samples)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("service").orderBy(*order))).where(F.col("rank") <= rule.samples).select("service", "rank", "message")
