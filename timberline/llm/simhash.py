"""SimHash: document fingerprints of 256 bits and a search of all fingerprints within a Hamming radius.

A text's terms are its words (ASCII white space, A-Z lower-cased) and its
five-word shingles. Every distinct term's hash votes on each bit for 1 or
against it, with a weight that grows with the logarithm of the term's
frequency in the text; a bit is set where the votes for it prevail. Two
fingerprints estimate the cosine of their texts' term vectors.

The search cuts a fingerprint into one block more than the radius, so that two
fingerprints within the radius have at least one block in common. Each block
in turn is the key of a table; fingerprints that meet in a table are compared
in tiles, and a pair counts in the first table where it meets.

Defined results: a null text is empty; a text without words has the
fingerprint of all zeros. Rows that share a doc_id follow each other by a hash
of their text, null ids come last. A single row is its own next document.
Other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import batches_by_size, scratch, small_side, sole_cache, written
from timberline.llm.ngram_join import _A, _WORDS, WORDS, _mixed

BITS = 256
#: Fingerprints that differ in so many bits at most are near in the search; one block more than that cuts them.
RADIUS = 7
#: Weights are whole multiples of a part of this size, so that sums don't depend on their order.
PARTS = 64
#: Terms whose votes are summed at once.
TERMS = 65_536
#: Fingerprints of a tile's side in the search, and pairs that are compared at once.
TILE, PAIRS = 4_096, 1 << 19

_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
_COLUMN = (np.arange(BITS // 8) * 256).astype(np.int64)


def term_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of all words and shingles of each text; fewer than five words are one shingle."""
    words = [x.lower().split() for x in texts]
    sole_cache("words", _WORDS.clear)
    if len(_WORDS) > 200_000:
        _WORDS.clear()
    lengths = [len(w) for w in words]
    h = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(words)), np.uint64, sum(lengths))

    def rolled(h: np.ndarray, k: int) -> np.ndarray:
        n = max(len(h) - k + 1, 0)
        acc = np.full(n, k, np.uint64)
        for j in range(k if n else 0):
            acc *= _A
            acc += h[j : j + n]
        return _mixed(acc)

    all_shingles, out, at = rolled(h, WORDS), [], 0
    for n in lengths:
        own = h[at : at + n]
        out.append(np.concatenate([own, all_shingles[at : at + n - WORDS + 1] if n >= WORDS else rolled(own, n) if n else own]))
        at += n
    return out


def fingerprint(terms: np.ndarray) -> np.ndarray:
    """The bits (packed, 32 bytes) that the weighted votes of a text's term hashes set."""
    terms, counts = np.unique(terms, return_counts=True)
    weights = np.rint(PARTS * (1 + np.log(counts)))
    votes = np.zeros(BITS)
    for i in range(0, len(terms), TERMS):
        own, w = terms[i : i + TERMS], weights[i : i + TERMS]
        data = _mixed(own[:, None] + _SEEDS).view(np.uint8)
        # how much weight has each value of each byte; then what those values say about their bits
        sums = np.bincount((data + _COLUMN).ravel(), np.repeat(w, BITS // 8), BITS * 32)
        votes += (sums.reshape(BITS // 8, 256) @ _BIT_OF_BYTE).ravel()
    return np.packbits(2 * votes > weights.sum())


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One row of 32 bytes for each text."""
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    for i, terms in enumerate(term_hashes(texts)):
        if len(terms):
            out[i] = fingerprint(terms)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the term vectors, at least 0: the angle is that share of a half turn in which the bits differ."""
    different = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
    return np.maximum(np.cos(math.pi * different / BITS), 0.0)


def edited(text: str, following: str) -> str:
    """The last third of the code points gives way to as many of the next document's first ones, or all of them."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_DONE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray):
    """Result columns of documents, given their and their next documents' fingerprints."""
    import pyarrow as pa

    changed = [edited(a, b).encode() for a, b in zip(texts, following)]
    other = fingerprints(changed)
    return [
        pa.array(ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in changed]),
        pa.array([x.tobytes().hex() for x in own], pa.string()), pa.array([x.tobytes().hex() for x in other], pa.string()),
        pa.array(likeness(own, other)), pa.array(likeness(own, after)),
    ]


def in_sequence(docs: DataFrame) -> DataFrame:
    """Every document with its own and its edited text's fingerprint, in falling order of doc_id.

    Ranges of the order are streamed through, one document behind the other. The
    first and the last document of every range come out with their texts, and are
    matched across ranges by a join of as many rows as there are ranges.
    """
    spark = docs.sparkSession
    names = [x.split()[0] for x in _DONE.split(", ")]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), None

        def made(kind, columns, texts):
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), *columns, pa.array(texts, pa.string())], names=["kind", "part", *names, "text"])

        def end(kind, doc_id, text, print_):
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            return made(kind, [pa.array([doc_id], pa.int64()), *none[:2], pa.array([print_.tobytes().hex()]), *none[2:]], [text])

        for batch in batches:
            ids, data = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in batches_by_size(data, 1_000_000):
                keys, texts = ids[a:b], data[a:b]
                prints = fingerprints([x.encode() for x in texts])
                if held is None:
                    yield end(1, keys[0], texts[0], prints[0])
                else:
                    keys, texts, prints = [held[0], *keys], [held[1], *texts], np.concatenate([held[2][None], prints])
                if len(keys) > 1:
                    yield made(0, _rows(keys[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:]), [None] * (len(keys) - 1))
                held = keys[-1], texts[-1], prints[-1]
        if held is not None:
            yield end(2, *held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    # rows that repeat an id and a text may lie in several ranges
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    ranges = spread.repartitionByRange(*order, "spread").sortWithinPartitions(*order, "spread").select("doc_id", "text")
    done = written(ranges.mapInArrow(run, f"kind int, part int, {_DONE}, text string"), "in-sequence")

    parts = sorted(r.part for r in done.where("kind = 1").select("part").collect())  # one number for each range
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    last = done.where("kind = 2").select("part", "doc_id", "text", "fingerprint").join(F.broadcast(following), "part")
    first = done.where("kind = 1").select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))

    def close(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts, own, next_texts, after = (c.to_pylist() for c in batch.columns)
            raw = [np.frombuffer(b"".join(map(bytes.fromhex, x)), np.uint8).reshape(-1, BITS // 8) for x in (own, after)]
            yield pa.RecordBatch.from_arrays(_rows(ids, texts, next_texts, *raw), names=names)

    closed = last.join(first, "next").select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(close, _DONE)
    return done.where("kind = 0").select(*names).unionByName(closed)


def near_counts(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """How many other fingerprints of ``prints`` (column fingerprint, hexadecimal, distinct) lie within ``radius``: fingerprint, n_near.

    Only fingerprints that have one come out. A bucket of a block table is
    numbered and cut into tiles of ``TILE`` fingerprints; every two tiles are a
    unit of their own, so a large bucket is many tasks. Numbers per fingerprint
    leave a unit, not pairs.
    """
    blocks = radius + 1
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    if any(c % 4 for c in cuts):
        raise ValueError("blocks have to end on whole hexadecimal digits")
    bits = np.arange(BITS)
    masks = [np.packbits((bits >= a) & (bits < b)).view(np.uint64) for a, b in zip(cuts, cuts[1:])]
    keys = F.array(*(F.substring("fingerprint", a // 4 + 1, (b - a) // 4) for a, b in zip(cuts, cuts[1:])))
    posted = prints.select("fingerprint", F.posexplode(keys).alias("block", "key"))
    sizes = posted.groupBy("block", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = posted.join(small_side(sizes, "near-sizes"), ["block", "key"])
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), tiles).cast("int")
    # a tile meets itself and all others of its bucket, in units that name the lower one first
    units = met.select(
        "block", "key", own.alias("tile"), "fingerprint", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")
    ).select("block", "key", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "fingerprint")

    def counted(block, low, high, tile, raw):
        """Numbers of near fingerprints of one unit's rows."""
        words = raw.view(np.uint64)
        found = np.zeros(len(raw), np.int64)
        one = np.flatnonzero(tile == low)
        two = one if low == high else np.flatnonzero(tile == high)
        step = max(1, PAIRS // max(len(two), 1))
        for i in range(0, len(one), step):
            rows = one[i : i + step]
            different = np.zeros((len(rows), len(two)), np.uint16)
            for j in range(words.shape[1]):
                different += np.bitwise_count(words[rows, j][:, None] ^ words[two, j][None, :])
            a, b = np.nonzero(different <= radius)
            a, b = rows[a], two[b]
            ok = a < b if low == high else np.ones(len(a), bool)
            a, b = a[ok], b[ok]
            differ = words[a] ^ words[b]
            ok = np.ones(len(a), bool)
            for t in range(block):  # not met before
                ok &= ((differ & masks[t]) != 0).any(1)
            np.add.at(found, a[ok], 1)
            np.add.at(found, b[ok], 1)
        return found

    def run(batches):
        import pyarrow as pa

        def out(rows):
            block, key, low, high, tile, prints_ = rows
            raw = np.frombuffer(bytes.fromhex("".join(prints_)), np.uint8).reshape(-1, BITS // 8)
            same = np.ones(len(key), bool)
            same[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            starts = [*np.flatnonzero(same).tolist(), len(key)]
            found = np.concatenate([counted(int(block[a]), int(low[a]), int(high[a]), tile[a:b], raw[a:b]) for a, b in zip(starts, starts[1:])])
            hit = found > 0
            return pa.RecordBatch.from_arrays([pa.array(prints_[hit], pa.string()), pa.array(found[hit])], names=["fingerprint", "n_near"])

        held = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(held, rows)]
            if not len(rows[0]):
                continue
            last = (rows[1] == rows[1][-1]) & (rows[0] == rows[0][-1]) & (rows[2] == rows[2][-1]) & (rows[3] == rows[3][-1])
            n = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if n:
                yield out([x[:n] for x in rows])
            held = [x[n:] for x in rows]
        if held is not None:
            yield out(held)

    unit = ["block", "key", "low", "high"]
    dealt = units.repartition(*unit).sortWithinPartitions(*unit)
    return dealt.mapInArrow(run, "fingerprint string, n_near long").groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))


def fingerprinted(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and n_near.

    n_near is the number of other documents' different fingerprints within ``radius``.
    """
    with scratch(docs.sparkSession) as keep:
        rows = in_sequence(docs)
        near = near_counts(rows.select("fingerprint").distinct(), radius)
        out = written(rows.join(small_side(near, "near-counts"), "fingerprint", "left").select(*[x.split()[0] for x in _DONE.split(", ")], F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")), "fingerprinted")
        keep(out)
    return out
