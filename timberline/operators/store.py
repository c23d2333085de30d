"""The log store: Parquet by day and batch; the last write of an id wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.operators import storeindex


def last_write(writes: DataFrame, keys: list[str] = ["id"], order: str = "indexed_at") -> DataFrame:  # noqa: B006
    """One row per key, the one written last; partial results are combined before the shuffle."""
    rest = [c for c in writes.columns if c not in keys]
    return writes.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("w")).select(*keys, *(F.col(f"w.{c}").alias(c) for c in rest))


def stored(entries: DataFrame, indexed_at) -> DataFrame:
    """Stored form of accepted entries: time of indexing, level's name and day of the event time."""
    return entries.withColumn("indexed_at", indexed_at).withColumn("event_date", F.to_date("timestamp"))


def create(spark: SparkSession, path: str) -> None:
    """An empty store, if there is none."""
    from timberline.sources.tables import LOG_SCHEMA

    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        empty = spark.createDataFrame([], LOG_SCHEMA).withColumns({"event_date": F.to_date("timestamp"), "batch": F.lit("")})
        empty.write.partitionBy("event_date", "batch").parquet(path)


def rows_schema() -> T.StructType:
    """Columns of a store's rows, with those of its folders: event_date and batch."""
    from timberline.sources.tables import LOG_SCHEMA

    return T.StructType([*LOG_SCHEMA.fields, T.StructField("event_date", T.DateType()), T.StructField("batch", T.StringType())])


def rows_of(spark: SparkSession, path: str, parts: list[str]) -> DataFrame:
    """Rows of some folders or files of a store."""
    return spark.read.schema(rows_schema()).option("basePath", path).parquet(*parts)


def read(spark: SparkSession, path: str) -> DataFrame:
    return rows_of(spark, path, [path]).drop("batch")


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of a folder's partitions; none if there is no such folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [n[len(prefix) :] for n in (x.getPath().getName() for x in fs.listStatus(p)) if n.startswith(prefix)]


def day_folders(spark: SparkSession, path: str) -> list[str]:
    """Days of a store, the latest first; records without a time come last."""
    return sorted(_names(spark, path, "event_date="), key=lambda x: (not x.startswith("__"), x), reverse=True)


def batch_folders(spark: SparkSession, path: str, day: str) -> list[str]:
    return _names(spark, f"{path}/event_date={day}", "batch=")


def files_of(spark: SparkSession, path: str, days: list[str]) -> list[str]:
    """The files of some days, as Spark lists them."""
    return rows_of(spark, path, [f"{path}/event_date={x}" for x in days]).inputFiles() if days else []


def current(spark: SparkSession, path: str) -> DataFrame:
    """The store with one row per id over all days and batches.

    A redelivered record lies in several batches, and one without a time of its
    own that is read again after midnight in two days; this keeps its last write.
    """
    return last_write(read(spark, path))


def batch_rows(entries: DataFrame, batch: int | str) -> DataFrame:
    """A batch's rows, each id once, in tasks of even size, each with few days: a large day is split, small ones share a task."""
    return last_write(entries).withColumn("batch", F.lit(str(batch))).hint("rebalance", "event_date")


def append(spark: SparkSession, path: str, entries: DataFrame, batch: int | str, indexed: bool = True) -> None:
    """Add a batch of stored entries as files of its own in every day that it touches, and their entries in the index.

    Nothing of what is there is read or rewritten, but for the same batch's
    files: a batch that is written again after a failure replaces itself.
    """
    batch_rows(entries, batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch").parquet(path)
    if indexed:
        storeindex.add(spark, path, str(batch))


def compact(spark: SparkSession, path: str, day) -> int:
    """Merge a day's batches into one, the last write of each id; returns how many there were.

    The merged files are written before the others go, so that a reader of
    ``current`` sees the same rows at any time, and after a failure too.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/event_date={day}")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [x.getPath() for x in fs.listStatus(fs_path) if x.getPath().getName().startswith("batch=")] if fs.exists(fs_path) else []
    if len(old) > 1:
        name = f"merged-{max([0, *(int(x.getName().rpartition('-')[2]) for x in old if x.getName().startswith('batch=merged-'))]) + 1}"
        schema = T.StructType([f for f in read(spark, path).schema.fields if f.name != "event_date"])
        rows = last_write(spark.read.schema(schema).option("basePath", str(fs_path)).parquet(*(str(x) for x in old)))
        rows.hint("rebalance").write.parquet(f"{fs_path}/batch={name}")
        storeindex.add(spark, path, name, str(day))
        for x in old:
            fs.delete(x, True)
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{storeindex.location(path)}/event_date={day}/{x.getName()}"), True)
    return len(old)


def upsert(spark: SparkSession, path: str, entries: DataFrame, batch: int | str) -> int:
    """Append a batch and merge the days that it touches; returns how many days those are."""
    append(spark, path, entries, batch)
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/event_date=*/batch={batch}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    days = [x.getPath().getParent().getName().partition("=")[2] for x in found or ()]
    for day in days:
        compact(spark, path, day)
    return len(days)
