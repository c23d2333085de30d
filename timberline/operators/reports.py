"""Small questions over logs, requests and runs: counts, spans, shares, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    """keys and n, the number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def lookup(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is wanted, by one semi join of any size; repeated wishes don't repeat rows."""
    return rows.join(wanted.select(key), key, "left_semi")


def span(logs: DataFrame) -> DataFrame:
    """One row: first reading and last indexing in microseconds, and n."""
    return logs.agg(F.unix_micros(F.min("observed_at")).alias("first_us"), F.unix_micros(F.max("indexed_at")).alias("last_us"), F.count(F.lit(1)).alias("n"))


def indexed_share(logs: DataFrame, start: str, end: str) -> DataFrame:
    """One row: how many records were indexed for each one read between two times."""
    between = lambda c: F.count_if(F.col(c) < F.lit(end).cast("timestamp")) - F.count_if(F.col(c) < F.lit(start).cast("timestamp"))
    return logs.agg((between("indexed_at") / between("observed_at")).alias("share"))


def level_matrix(logs: DataFrame, key: str, levels: tuple[str, ...]) -> DataFrame:
    """Numbers of records by key, a column for each level; 0 where there are none."""
    return logs.groupBy(key).agg(*(F.count_if(F.col("level") == x).alias(x) for x in levels))


def first_seen(logs: DataFrame, value: Column, name: str, order: str = "offset") -> DataFrame:
    """Each different value with the first place that has it."""
    return logs.groupBy(value.alias(name)).agg(F.min(order).alias("first_seen"))


def counters(names: DataFrame, pattern: str) -> DataFrame:
    """name and value of the counters that a pattern selects and that aren't 0."""
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("value")).where(F.col("name").rlike(pattern) & (F.col("value") > 0))


def pooled(parts: dict[str, DataFrame], columns: list[str], label: str) -> DataFrame:
    """All parts' columns, one below the other, with the part's name in ``label``."""
    frames = [df.select(*columns, F.lit(name).alias(label)) for name, df in parts.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def after_warmup(samples: DataFrame, order: str, start) -> DataFrame:
    """Samples that began after the warm-up."""
    return samples.where(F.col(order) >= start)


def mean_peak(readings: DataFrame, key: str, value: str) -> DataFrame:
    return readings.groupBy(key).agg(F.avg(value).alias("mean"), F.max(value).alias("peak"))


def status_counts(requests: DataFrame, status: str) -> DataFrame:
    """One row: ``status:number`` of all statuses between commas, in order, and the number of requests."""
    n = count_by(requests, status)
    entries = F.array_sort(F.collect_list(F.struct(status, "n")))  # one per status
    pairs = F.transform(F.col("e"), lambda x: F.concat(x[status], F.lit(":"), x["n"]))
    return n.agg(entries.alias("e"), F.sum("n").alias("requests")).select(F.array_join(pairs, ",").alias("counts"), "requests")


def hit_miss(requests: DataFrame, value: str, hit: str, points: dict[str, float]) -> DataFrame:
    """One row: nearest-rank percentiles of hits and of misses, and the number of hits."""
    from timberline.operators.percentiles import grouped

    rows = requests.withColumn("__hit", F.expr(hit)).where("__hit IS NOT NULL")
    found = grouped(rows, ["__hit"], value, points)  # two rows
    columns = [F.max(F.when(F.col("__hit") == is_hit, F.col(name))).alias(f"{kind}_{name}") for kind, is_hit in (("hit", True), ("miss", False)) for name in points]
    n = requests.agg(F.count_if(hit).alias("hits"))
    return found.agg(*columns).join(F.broadcast(n))


def ratios(medians: DataFrame, variant: str, value: str) -> DataFrame:
    """one, two and ratio for every pair of variants; variants are as few as a report has lines."""
    all_ = medians.agg(F.array_sort(F.collect_list(F.struct(variant, value))).alias("m"))
    pairs = all_.select("m", F.posexplode("m").alias("i", "a")).select("a", F.explode(F.expr("slice(m, i + 2, size(m))")).alias("b"))
    return pairs.select(F.col(f"a.{variant}").alias("one"), F.col(f"b.{variant}").alias("two"), (F.col(f"a.{value}") / F.col(f"b.{value}")).alias("ratio"))
