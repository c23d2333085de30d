"""Exact deduplication on disk-backed streaming state.

Digests of normalised texts flow through a streaming aggregation whose state
lies in RocksDB and never expires. It retains, for every digest, the stable
identifier of the row that stays, the locator of that row's content, and the
number of rows. Hits are checked against the full bytes at the locator. All of
it runs JVM-side; a lost executor reloads its part of the state from the
checkpoint.
"""

from __future__ import annotations

import string

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.common import shared_dir, written

#: State lies on disk, and a worker holds open only the stores of the tasks that it runs.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
}
#: Files of digests that one micro-batch takes.
FILES_PER_BATCH = 2000
#: Rows of one group that are compared with one copy of its content.
SALT_ROWS = 256


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased; null becomes empty."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    only_ascii = F.octet_length(t) == F.length(t)
    return F.when(only_ascii, F.lower(t)).otherwise(F.translate(t, string.ascii_uppercase, string.ascii_lowercase))


def located(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the locator of every row, in two columns whose names come along; a table without files is written first."""
    prefix = "__dedup_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    names = f"{prefix}file", f"{prefix}row"

    def add(df: DataFrame) -> DataFrame:
        own = df.metadataColumn("_metadata")
        return df.withColumns({names[0]: own["file_path"], names[1]: own["row_index"]})

    try:
        return add(docs), *names
    except AnalysisException:
        return add(written(docs, "located")), *names


def digest_table(rows: DataFrame) -> DataFrame:
    """Digest, size, identifier and locator of every row (doc_id, text, __dedup_file, __dedup_row), in the shared folder."""
    text = normalised(F.col("text"))
    return written(
        rows.select("doc_id", text.alias("_text"), "__dedup_file", "__dedup_row")
        .select("doc_id", F.sha2("_text", 256).alias("sha"), F.octet_length("_text").cast("long").alias("bytes"), "__dedup_file", "__dedup_row"),
        "digests",
    )


def stream_state(spark: SparkSession, path: str, schema, checkpoint: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Run the digests under ``path`` through the keyed state and return the state.

    The same checkpoint takes up where it ended when more files arrive. Columns:
    sha, bytes, keep (identifier and locator of the row that stays) and rows.
    """
    checkpoint = checkpoint or shared_dir(spark, "dedup-state")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        keyed = (
            spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
            .groupBy("sha", "bytes")
            .agg(F.max(F.struct("doc_id", "__dedup_file", "__dedup_row")).alias("keep"), F.count(F.lit(1)).alias("rows"))
        )
        query = (
            keyed.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        names = [f.name for f in state.schema["value"].dataType.fields]
        # the value holds the buffers of the aggregates in their order
        state = state.select(F.col("key.sha").alias("sha"), F.col("key.bytes").alias("bytes"), F.col("value")[names[-2]].alias("keep"), F.col("value")[names[-1]].alias("rows"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return state


def differing(rows: DataFrame, hits: DataFrame, groups: DataFrame) -> int:
    """Number of hits whose full bytes differ from those at their group's locator.

    Contents of a large group are compared with several copies of the kept one,
    a copy for every ``SALT_ROWS`` rows.
    """
    salts = F.ceil(F.col("rows") / SALT_ROWS).cast("int")
    texts = rows.select("__dedup_file", "__dedup_row", normalised(F.col("text")).alias("_text"))
    kept = (
        texts.join(groups.select(F.col("keep.__dedup_file").alias("__dedup_file"), F.col("keep.__dedup_row").alias("__dedup_row"), "sha", "rows"), ["__dedup_file", "__dedup_row"])
        .select("sha", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("_text").alias("_kept"))
    )
    own = (
        texts.join(hits.select("__dedup_file", "__dedup_row", "sha", "rows"), ["__dedup_file", "__dedup_row"])
        .select("sha", F.pmod(F.xxhash64("__dedup_file", "__dedup_row"), salts).cast("int").alias("salt"), "_text")
    )
    return own.join(kept, ["sha", "salt"]).where(F.col("_text") != F.col("_kept")).count()


def assigned(docs: DataFrame) -> tuple[DataFrame, DataFrame, str, str]:
    """Located rows of ``docs``, for each: doc_id, __dedup_file, __dedup_row, keep_id, group_size, kept, text_sha256, and the names of the located rows' file and row.

    Of equal texts (A-Z lower-cased; null counts as empty) the row with the
    largest doc_id stays, and of rows that share that id the one whose locator
    is largest; null ids are the smallest. Should texts with one digest differ,
    all rows are grouped by digest and full text instead. Empty tables give
    empty results.
    """
    spark = docs.sparkSession
    located_, file, row = located(docs)
    rows = located_.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col(file).alias("__dedup_file"), F.col(row).alias("__dedup_row"))
    table = digest_table(rows)
    path = table.inputFiles()
    state = written(stream_state(spark, _folder(path), table.schema), "dedup-groups") if path else None
    if state is None:
        empty = table.select("doc_id", "__dedup_file", "__dedup_row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
        return located_, empty, file, row
    groups = state.where("rows > 1")
    joined = table.join(state, ["sha", "bytes"])
    here = (F.col("__dedup_file") == F.col("keep.__dedup_file")) & (F.col("__dedup_row") == F.col("keep.__dedup_row"))
    hits = table.join(groups, ["sha", "bytes"]).where(~here)
    if differing(rows, hits, groups):
        full = rows.select("doc_id", "__dedup_file", "__dedup_row", normalised(F.col("text")).alias("_text"))
        own = full.groupBy("_text").agg(F.max(F.struct("doc_id", "__dedup_file", "__dedup_row")).alias("keep"), F.count(F.lit(1)).alias("rows"))
        joined = full.join(own, "_text").withColumn("sha", F.sha2("_text", 256))
    return located_, joined.select(
        "doc_id", "__dedup_file", "__dedup_row", F.col("keep.doc_id").alias("keep_id"), F.col("rows").alias("group_size"), here.alias("kept"), F.col("sha").alias("text_sha256")
    ), file, row


def _folder(files: list[str]) -> str:
    return files[0].rsplit("/", 1)[0]


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256; other columns are ignored."""
    return assigned(docs.select("doc_id", "text"))[1].drop("__dedup_file", "__dedup_row")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names are."""
    rows, out, file, row = assigned(docs)
    stay = out.where("kept").select(F.col("__dedup_file").alias(file), F.col("__dedup_row").alias(row))
    return rows.join(stay, [file, row], "left_semi").select(*docs.columns)


ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY x) AS keep_id,
       count(*) OVER (PARTITION BY x) AS group_size,
       row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(x) AS text_sha256
FROM t
"""
