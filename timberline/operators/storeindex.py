"""An index beside the store: for every file, Bloom filters of its ids and of its messages' terms.

A filter is cut into blocks of 32,768 bits. A value's hash names its block and
four places in it, so that a lookup joins one small row per value and width of
filters. The index lies in the store's folder under a name that readers of the
store pass over; a file that has no entry yet is read in any case, so a failure
between writing a batch and its entries costs time only.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.functions.text import terms

BLOCK_BITS, PLACES = 32_768, 4
#: Bits for every different value of a filter, at least: about one of 1,000 ids and one of 100 terms is taken for present that isn't.
BITS = {"id": 20, "term": 10}
#: Filters have a power of two of blocks, up to 2 to the power of this.
WIDEST = 24
ENTRIES = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("last_indexed", T.TimestampType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("bits", T.BinaryType()),
])


def location(path: str) -> str:
    return f"{path}/_index"


def filter_blocks(hashes: np.ndarray, bits: int) -> tuple[int, np.ndarray]:
    """Width and blocks (one row of bytes each) of a filter of 64-bit hashes."""
    hashes = np.unique(hashes).view(np.uint64)
    width = 1
    while width * BLOCK_BITS < len(hashes) * bits and width < 1 << WIDEST:
        width *= 2
    out = np.zeros((width, BLOCK_BITS // 8), np.uint8)
    block = ((hashes >> np.uint64(60 - WIDEST)) & np.uint64(width - 1)).astype(np.int64)
    for i in range(PLACES):
        place = ((hashes ^ (hashes >> np.uint64(29))) >> np.uint64(15 * i)) & np.uint64(BLOCK_BITS - 1)
        place = place.astype(np.int64)
        np.bitwise_or.at(out, (block, place >> 3), (1 << (place & 7)).astype(np.uint8))
    return width, out


def _bits(h: Column, width: Column) -> tuple[Column, Column]:
    """Block of a hash in a filter of so many blocks, and its places: what ``filter_blocks`` does."""
    block = F.shiftrightunsigned(h, 60 - WIDEST).bitwiseAND(width.cast("long") - 1).cast("int")
    mixed = h.bitwiseXOR(F.shiftrightunsigned(h, 29))
    return block, F.array(*(F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(PLACES)))


def _set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1


def entries_of(rows: DataFrame) -> DataFrame:
    """Index entries of rows of the store, file by file; a file that several tasks read has an entry for each part."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), None

        def out(held):
            path, date, batch, n, last, ids, words = held
            file = path.rsplit("/", 1)[1]
            for kind, hashes in (("id", ids), ("term", words)):
                width, blocks = filter_blocks(np.concatenate(hashes) if hashes else np.zeros(0, np.int64), BITS[kind])
                yield pa.RecordBatch.from_pylist(
                    [{"file": file, "part": part, "kind": kind, "rows": n, "last_indexed": last, "width": width, "block": i, "bits": x.tobytes(), "event_date": date, "batch": batch} for i, x in enumerate(blocks)],
                    schema=schema,
                )

        schema = pa.schema([
            ("file", pa.string()), ("part", pa.int32()), ("kind", pa.string()), ("rows", pa.int64()), ("last_indexed", pa.timestamp("us", "UTC")),
            ("width", pa.int32()), ("block", pa.int32()), ("bits", pa.binary()), ("event_date", pa.date32()), ("batch", pa.string()),
        ])
        for b in batches:
            if not b.num_rows:
                continue
            files = b.column(0).dictionary_encode()
            codes = files.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                path = files.dictionary[int(codes[lo])].as_py()  # days and batches may have files of one name
                if held is not None and held[0] != path:
                    yield from out(held)
                    held = None
                if held is None:
                    held = [path, b.column(1)[lo].as_py(), b.column(2)[lo].as_py(), 0, None, [], []]
                last = b.column(3)[lo:hi]
                held[3] += hi - lo
                held[4] = max((x for x in (held[4], max((y for y in last.to_pylist() if y is not None), default=None)) if x is not None), default=None)
                held[5].append(np.unique(b.column(4)[lo:hi].to_numpy()))
                held[6].append(np.unique(b.column(5)[lo:hi].flatten().to_numpy()))
        if held is not None:
            yield from out(held)

    hashed = rows.select(
        F.col("_metadata.file_path").alias("file"), "event_date", "batch", "indexed_at", F.xxhash64("id").alias("id"),
        F.transform(F.coalesce(terms(F.col("message")), F.array().cast("array<string>")), lambda x: F.xxhash64(x)).alias("words"),
    )
    return hashed.mapInArrow(run, T.StructType([*ENTRIES.fields, T.StructField("event_date", T.DateType()), T.StructField("batch", T.StringType())]))


def add(spark: SparkSession, path: str, batch: str, day: str = "*") -> None:
    """Write the entries of a batch's files, of one day or all; those of the same batch that are there are replaced."""
    from timberline.operators.store import rows_of

    try:
        rows = rows_of(spark, path, [f"{path}/event_date={day}/batch={batch}"])
    except AnalysisException:  # a batch without rows has no files
        return
    entries_of(rows).hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch").parquet(location(path))


def entries(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """The index, of some days only if they are given; None if there is none."""
    schema = T.StructType([*ENTRIES.fields, T.StructField("event_date", T.DateType()), T.StructField("batch", T.StringType())])
    try:
        rows = spark.read.schema(schema).parquet(location(path))
    except AnalysisException:
        return None
    return rows if days is None else rows.where(F.col("event_date").isin([dt.date.fromisoformat(x) for x in days]))


def file_key(path: str) -> tuple[str, str, str]:
    """Day, batch and name of a store's file."""
    day, batch, name = path.rsplit("/", 3)[1:]
    return day.partition("=")[2], unquote(unquote(batch.partition("=")[2])), name


def narrowed(spark: SparkSession, path: str, files: list[str], kind: str, values: Column, every: bool, since: dt.datetime | None = None) -> list[str]:
    """Those of ``files`` that may hold every value, or any, of a few (``values``, an array of hashes that needs no row); with ``since``, also something indexed then or later.

    Files without an entry stay. The values are those of a request: they are broadcast, once for each width of filters.
    """
    days = sorted({file_key(x)[0] for x in files})
    index = entries(spark, path, [x for x in days if not x.startswith("__")])
    if index is None or not files:
        return files
    index = index.where(F.col("kind") == kind)
    width = F.col("width")
    asked = spark.range(1).select(F.explode(F.array_distinct(values)).alias("h")).select("h", F.explode(F.lit([1 << i for i in range(WIDEST + 1)])).alias("width"))
    block, places = _bits(F.col("h"), width)
    asked = asked.select("h", "width", block.alias("block"), places.alias("places"))
    hit = index.join(F.broadcast(asked), ["width", "block"]).where(F.forall("places", lambda p: _set(F.col("bits"), p)))
    one = ["event_date", "batch", "file", "part"]
    hit = hit.groupBy(*one).agg(F.count_distinct("h").alias("hits"))
    if every:
        hit = hit.where(F.col("hits") == F.size(F.array_distinct(values)))
    known = index.where("block = 0")
    fits = F.col("hits").isNotNull()
    if since is not None:
        fits &= F.col("last_indexed") >= F.lit(since)
    found = known.join(hit, one, "left").groupBy("event_date", "batch", "file").agg(F.max(fits).alias("fits")).collect()  # one row for each file, as in Spark's own listing
    out = {(str(r.event_date), r.batch, r.file): r.fits for r in found}
    return [x for x in files if out.get(file_key(x), True)]


def term_hashes(text: str) -> Column:
    """Hashes of a query's different terms."""
    return F.transform(F.array_distinct(terms(F.lit(text))), lambda x: F.xxhash64(x))


def id_hashes(ids: list[str]) -> Column:
    return F.transform(F.lit(ids), lambda x: F.xxhash64(x))


def unseen(spark: SparkSession, path: str, batch: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Entries of a batch (id, timestamp, observed_at, event_date, ...) whose ids the store doesn't hold, however old what it holds is.

    Records with a time of their own are looked for in their day, others in all
    days. Only files whose filters say that they may hold one of the ids are
    opened, and only ids that a filter knows are compared. Also returns how many
    files those days have and how many of them are opened. A batch's own
    repetitions are left to the store. ``batch`` is read several times: persist
    it, or read it from a table.
    """
    from timberline.operators.store import day_folders, files_of, rows_of

    keyed = batch.select("id", "event_date", F.coalesce(F.col("timestamp") == F.col("observed_at"), F.lit(True)).alias("open"), F.xxhash64("id").alias("h"))
    spans = keyed.groupBy("event_date").agg(F.max("open").alias("open")).collect()  # one row for each day of the batch
    days = day_folders(spark, path)
    if not any(r.open for r in spans):
        own = {str(r.event_date) for r in spans}
        days = [x for x in days if x in own]
    files = files_of(spark, path, days)
    index = entries(spark, path, [x for x in days if not x.startswith("__")])
    if not files:
        return batch, {"files": 0, "opened": 0}
    if index is None:
        possible, opened = keyed, files
    else:
        index = index.where(F.col("kind") == "id")
        known = {(str(r.event_date), r.batch, r.file) for r in index.where("block = 0").select("event_date", "batch", "file").distinct().collect()}
        widths = [r.width for r in index.select("width").distinct().collect()] or [1]
        block, places = _bits(F.col("h"), F.col("width"))
        asked = keyed.withColumn("width", F.explode(F.lit(widths))).select(F.col("id"), "open", F.col("event_date").alias("day"), "width", block.alias("block"), places.alias("places"))
        hit = index.join(asked, ["width", "block"]).where(F.forall("places", lambda p: _set(F.col("bits"), p)) & (F.col("open") | (F.col("day") == F.col("event_date"))))
        hits = hit.select("id", "event_date", "batch", "file").persist()
        may = {(str(r.event_date), r.batch, r.file) for r in hits.select("event_date", "batch", "file").distinct().collect()}
        plain = [x for x in files if file_key(x) not in known]
        opened = plain + [x for x in files if file_key(x) in may]
        possible = keyed if plain else hits
    if not opened:
        return batch, {"files": len(files), "opened": 0}
    stored = rows_of(spark, path, opened).select("id")
    there = possible.select("id").distinct().join(stored, "id", "left_semi")
    return batch.join(there, "id", "left_anti"), {"files": len(files), "opened": len(opened)}
