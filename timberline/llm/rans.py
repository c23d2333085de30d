"""Token ids as interleaved rANS blocks.

One static frequency table, counted over the whole corpus and scaled to
``2 ** SCALE`` slots, is shared by all blocks. A block holds whole documents of
one sorted run and codes its ids with many interleaved states, so that a decoder
advances all lanes at once; blocks know nothing of each other. Block rows carry
their documents' ids and lengths, checksums of the ids and of the coded bytes,
and serve as checkpoints: any of them can be decoded on its own.

The file format is a Parquet table of block rows, so that it can lie in any
store that Spark reaches; ``table`` beside it holds the frequencies.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.llm.common import id_encoder, remove, shared_dir, slices_by_size

END_ID = 1
SCALE = 20
BLOCK_TOKENS = 1 << 18
LANES = 2048
#: Encoded chunks that each of a worker's two tables keeps, beside the sort that feeds it.
CHUNKS = 250_000
#: Lower bound of a state between two steps; states stay under 2 ** 63.
LOW = 1 << 31

#: Rows of a run are numbered from 0; row -1 holds the counts of its ids.
RUNS = "pid int, seq long, doc_id long, ids binary, counts binary"
BLOCKS = (
    "pid int, seq long, n_docs long, n_tokens long, doc_ids array<long>, lengths array<long>, "
    "lanes int, states binary, words binary, ids_crc32 long, coded_crc32 long"
)


class Table:
    """Slots of each id, scaled to ``2 ** SCALE``; every id that occurs has one at least."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = np.asarray(ids, np.uint32)[order], np.asarray(counts, np.int64)[order]
        slots = 1 << SCALE
        if not 0 < len(self.ids) <= slots:
            raise ValueError(f"{len(self.ids)} different ids for {slots} slots")
        total = int(counts.sum())
        freq = np.array([max(1, int(c) * slots // total) for c in counts.tolist()], np.int64)
        rest = slots - int(freq.sum())
        if rest > 0:
            freq[freq.argmax()] += rest
        while rest < 0:  # the largest give back what the rarest got in excess
            k = int(freq.argmax())
            take = min(-rest, int(freq[k]) // 2)
            freq[k] -= take
            rest += take
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.index = np.zeros(int(self.ids[-1]) + 1, np.int64)
        self.index[self.ids] = np.arange(len(self.ids))
        self._slot = None

    @property
    def slot(self) -> np.ndarray:
        if self._slot is None:
            self._slot = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
        return self._slot


def encode_block(ids: np.ndarray, table: Table) -> tuple[int, bytes, bytes]:
    """Lanes, final states and coded words of at least one id."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    symbols = table.index[ids]
    freq, start = table.freq[symbols], table.start[symbols]
    top = freq << np.uint64(43)
    x = np.full(lanes, LOW, np.uint64)
    words = []
    for at in range((n - 1) // lanes * lanes, -1, -lanes):
        f, c, m = freq[at : at + lanes], start[at : at + lanes], top[at : at + lanes]
        y = x[: len(f)]
        full = np.flatnonzero(y >= m)
        words.append(y[full].astype("<u4"))
        y[full] >>= np.uint64(32)
        q = y // f
        x[: len(f)] = (q << np.uint64(SCALE)) + (y - q * f) + c
    return lanes, x.astype("<u8").tobytes(), b"".join(w.tobytes() for w in reversed(words))


def decode_block(n: int, lanes: int, states: bytes, words: bytes, table: Table) -> np.ndarray:
    """The ``n`` ids of a block."""
    x = np.frombuffer(states, "<u8").copy()
    stream = np.frombuffer(words, "<u4").astype(np.uint64)
    out = np.empty(n, np.int32)
    mask, at_word = np.uint64((1 << SCALE) - 1), 0
    for at in range(0, n, lanes):
        k = min(lanes, n - at)
        y = x[:k]
        low = y & mask
        s = table.slot[low.astype(np.int64)]
        out[at : at + k] = s
        y = table.freq[s] * (y >> np.uint64(SCALE)) + low - table.start[s]
        need = np.flatnonzero(y < LOW)
        y[need] = (y[need] << np.uint64(32)) | stream[at_word : at_word + len(need)]
        at_word += len(need)
        x[:k] = y
    if at_word != len(stream) or (x != LOW).any():
        raise ValueError("a block's words do not lead back to the first state")
    return table.ids[out]


def sorted_runs(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids of every document, dealt by ranges of doc_id and sorted within them; nulls come first."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, end, pid, seq = id_encoder(tokenizer, CHUNKS), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        total = np.zeros(0, np.int64)

        def rows(seqs, ids, data, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array([pid] * len(seqs), pa.int32()), pa.array(seqs, pa.int64()), ids, pa.array(data, pa.binary()), pa.array(counts, pa.binary())],
                names=["pid", "seq", "doc_id", "ids", "counts"],
            )

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices_by_size(texts):
                found, bounds = encoder.encode(texts.slice(a, b - a))
                every, bounds = found.tobytes(), (4 * bounds).tolist()
                data = [every[x:y] + end for x, y in zip(bounds, bounds[1:])]
                c = np.bincount(found, minlength=max(len(total), end_id + 1))
                c[end_id] += b - a
                c[: len(total)] += total
                total = c
                yield rows(range(seq, seq + b - a), ids.slice(a, b - a), data, [None] * (b - a))
                seq += b - a
        if seq:
            yield rows([-1], pa.nulls(1, pa.int64()), [b""], [total.astype("<i8").tobytes()])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(run, RUNS)


def id_counts(runs: DataFrame) -> Table:
    """The table over all ids; its size is bounded by the vocabulary."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0):
                c = np.frombuffer(data.as_buffer(), "<i8")
                total = np.pad(total, (0, max(0, len(c) - len(total))))
                total[: len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    rows = runs.where("seq < 0").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return Table(np.array([END_ID]), np.array([1]))
    return Table(np.array([r.id for r in rows]), np.array([r.n for r in rows]))


def coded(runs: DataFrame, table, block_tokens: int) -> DataFrame:
    """Blocks of consecutive documents of a run with about ``block_tokens`` ids each."""

    def run(batches):
        import pyarrow as pa

        shared, held = table.value, []
        size = last = 0

        def block():
            data = b"".join(x[3] for x in held)
            ids = np.frombuffer(data, "<u4")
            lanes, states, words = encode_block(ids, shared)
            row = {
                "pid": held[0][0], "seq": held[0][1], "n_docs": len(held), "n_tokens": len(ids),
                "doc_ids": [x[2] for x in held], "lengths": [len(x[3]) // 4 for x in held],
                "lanes": lanes, "states": states, "words": words,
                "ids_crc32": zlib.crc32(data), "coded_crc32": zlib.crc32(words, zlib.crc32(states)),
            }
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([
            ("pid", pa.int32()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("lanes", pa.int32()),
            ("states", pa.binary()), ("words", pa.binary()), ("ids_crc32", pa.int64()), ("coded_crc32", pa.int64()),
        ])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (size >= block_tokens or row[0] != held[-1][0] or row[1] != last + 1):
                    yield block()
                    size = 0
                held.append(row)
                size += len(row[3]) // 4
                last = row[1]
        if held:
            yield block()

    return runs.where("seq >= 0").drop("counts").mapInArrow(run, BLOCKS)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the ids of all documents, ascending by doc_id, as coded blocks under ``path``.

    A null or empty text is the end id alone. Null ids come first, rows that
    repeat an id stand side by side in the order of a hash of their texts. An
    empty table gives an empty table of blocks.
    """
    spark = docs.sparkSession
    held = shared_dir(spark, "runs")
    sorted_runs(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(held)
    runs = spark.read.schema(RUNS).parquet(held)
    table = id_counts(runs)
    shared = spark.sparkContext.broadcast(table)
    coded(runs, shared, block_tokens).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame([(table.ids.astype("<u4").tobytes(), table.freq.astype("<u4").tobytes())], "ids binary, freq binary").coalesce(1).write.parquet(f"{path}/table")
    remove(spark, held)


def read_table(spark: SparkSession, path: str) -> Table:
    row = spark.read.parquet(f"{path}/table").first()
    return Table(np.frombuffer(row.ids, "<u4"), np.frombuffer(row.freq, "<u4").astype(np.int64))


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files under ``path``: pid, seq, doc_id, n_tokens, ids_crc32 and, if asked for, the ids.

    Blocks are decoded independently; one whose checksums differ raises ValueError.
    """
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def run(batches):
        import pyarrow as pa

        table = shared.value
        for batch in batches:
            for b in batch.to_pylist():
                if zlib.crc32(b["words"], zlib.crc32(b["states"])) != b["coded_crc32"]:
                    raise ValueError(f"block {b['pid']}:{b['seq']} is damaged")
                data = decode_block(b["n_tokens"], b["lanes"], b["states"], b["words"], table).astype("<u4").tobytes()
                if zlib.crc32(data) != b["ids_crc32"]:
                    raise ValueError(f"block {b['pid']}:{b['seq']} decodes to other ids")
                ends = np.cumsum(b["lengths"]) * 4
                parts = [data[e - 4 * n : e] for e, n in zip(ends.tolist(), b["lengths"])]
                n = len(parts)
                columns = [
                    pa.array([b["pid"]] * n, pa.int32()), pa.array(range(b["seq"], b["seq"] + n), pa.int64()), pa.array(b["doc_ids"], pa.int64()),
                    pa.array(b["lengths"], pa.int64()), pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                ]
                names = ["pid", "seq", "doc_id", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = "pid int, seq long, doc_id long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(run, fields)


def starts(rows: DataFrame) -> DataFrame:
    """Adds start: ids of all documents before, in the order of pid and seq.

    Runs are cumulated on their own; the totals of the runs, one row per written
    partition, are summed up before them.
    """
    totals = rows.groupBy("pid").agg(F.sum("n_tokens").alias("run_tokens"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("pid", F.coalesce(F.sum("run_tokens").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("pid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(bases, "pid")
        .withColumn("start", F.col("base") + F.col("inside"))
        .drop("base", "inside")
    )
