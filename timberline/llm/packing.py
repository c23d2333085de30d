"""Sum-of-squares packing of token sequences.

Every document becomes one item, or several where it is longer than a sequence;
an item goes to the open bin that makes the sum, over all residual gaps, of the
squared number of open bins with that gap smallest. Items are dealt to shards of
about ``SHARD`` items by a hash, so that no task holds more than its shard; each
shard is packed on its own and leaves at most a few sequences unfilled.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import id_encoder, slices_by_size, written

CAPACITY = 4096
END_ID = 1
#: Items that one task packs.
SHARD = 60_000
#: Encoded chunks that each of a worker's two tables keeps.
CHUNKS = 250_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack_sizes(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, placed in order of falling size by the sum-of-squares rule.

    Sizes lie between 1 and ``capacity``. Among equal placements the smallest
    gap wins. Ties in size keep the given order.
    """
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # twice the number of open bins per residual gap; gap 0 is closed, a gap of the whole capacity is a new bin
    twice = np.zeros(capacity + 1, np.int64)
    absent = np.full(capacity + 1, np.iinfo(np.int64).max // 4, np.int64)
    absent[capacity] = 0
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        # growth of the sum for each gap from s on, less the constant 2
        growth = twice[: capacity + 1 - s] - twice[s:] + absent[s:]
        growth[0] -= 1  # a filled bin leaves the count
        growth[-1] -= 1  # a new bin leaves no gap behind
        gap = s + int(growth.argmin())
        if gap == capacity:
            at = count
            count += 1
        else:
            at = open_bins[gap].pop()
            twice[gap] -= 2
            if not open_bins[gap]:
                absent[gap] = np.iinfo(np.int64).max // 4
        bins[i], offsets[i] = at, capacity - gap
        left = gap - s
        if left:
            open_bins[left].append(at)
            twice[left] += 2
            absent[left] = 0
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of every document: its ids, an end id, cut only where longer than ``capacity``."""

    def run(batches):
        import pyarrow as pa

        encoder = id_encoder(tokenizer, CHUNKS)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows = []
            for a, b in slices_by_size(texts):
                found, bounds = encoder.encode(texts.slice(a, b - a))
                data, bounds = found.tobytes(), (4 * bounds).tolist()
                for doc, x, y in zip(ids[a:b], bounds, bounds[1:]):
                    own = data[x:y] + end
                    for k, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at : at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and
    offset. A null or empty text is one piece of the end id alone. A null id
    stays null; rows that repeat an id are packed each for itself. An empty
    table gives an empty result; other columns are ignored.
    """
    items = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    whole = F.col("length") == capacity
    count = items.where(~whole).count()
    shards = max(1, -(-count // shard))

    def run(pdf):
        bins, offsets = pack_sizes(pdf["length"].to_numpy(np.int64), capacity)
        return pdf.assign(sequence_id=pdf["shard"].to_numpy(np.int64) * (1 << 32) + bins, offset=offsets).drop(columns="shard")

    fields = PIECES + ", sequence_id long, offset long"
    rest = (
        items.where(~whole)
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
        .groupBy("shard").applyInPandas(run, fields)
    )
    full = items.where(whole).select("*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(rest)
