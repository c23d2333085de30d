"""Jaccard join on word n-grams by size-banded tiles and hashed bitmap signatures.

Documents with one shingle set are one node. Nodes meet in tiles, one for every
pair of a shingle and a size band: a similar pair has a common shingle among
the first quarter of each set in one global order, frequent shingles last, and
lies in one band or in two adjacent ones. Bit counts of the nodes' bitmaps
bound the overlap from above, what passes is settled by intersecting the sorted
shingle arrays.

Tiles are worked off in two rounds, so that a group of copies costs links in
proportion to its size. First every node is compared with the first nodes of
its tiles only. Then all pairs whose nodes are not connected yet are tried, in
groups of tiles and in blocks of about ``BLOCK`` nodes each. No pair of different
components is left out, and pairs inside a component can't change it.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import batches_by_size, release, remove, scratch, small_batches, small_side, sole_cache, written

WORDS = 5
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles that so many documents share, by what is counted in tasks, come last in the order.
HEAVY = 8
#: Occurrences within a task from which a shingle is counted.
LOCAL = 2
#: Hashes that are counted: the order begins with the smallest ones, and a quarter of a set is looked up.
COUNTED = np.uint64(int(0.32 * 2**64))
#: Hashes that a task holds to count them together.
COUNT_HELD = 6_000_000
#: Keys of sets that a task remembers so as to give equal ones once.
KEYS_HELD = 500_000
#: Frequent shingles that are told apart at most; more only lose their place at the order's end.
MOST_HEAVY = 2_000_000
#: Bits of a small set's bitmap.
LEAST_BITS = 1024
#: Nodes of a tile that one block holds.
BLOCK = 256
#: Nodes of a group from which its main component is tried first, how many of that one's nodes at most, and how often.
LARGE, CENTRAL, ROUNDS = 24, 12, 2
#: Shingles of a block's sets together, on average, at most.
BLOCK_ITEMS = 500_000
#: Shingles whose occurrences in a block's sets are multiplied at once.
SLICE = 8192
#: Rows of one shingle that a task holds together.
HOLD = 100_000
#: Edges of one leader that one task compares.
CHUNK = 128



class _Hashes(dict):
    """64-bit hashes of words, computed when they first come up."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Hashes()
_A = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles: uint64, empty without words."""
    words = [(x or b"").lower().split() for x in texts]
    sole_cache("words", _WORDS.clear)
    if len(_WORDS) > 200_000:
        _WORDS.clear()
    lengths = np.array([len(w) for w in words], np.int64)
    h = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(words)), np.uint64, int(lengths.sum()))
    del words
    ends = np.cumsum(lengths)
    starts = ends - lengths

    def hashed(h: np.ndarray, k: int) -> np.ndarray:
        n = len(h) - k + 1
        acc = np.full(max(n, 0), k, np.uint64)
        for j in range(k if n > 0 else 0):
            acc *= _A
            acc += h[j : j + n]
        return _mixed(acc)

    # one pass over all texts; what begins in one and ends in the next is never read
    rolled = hashed(h, WORDS)
    none = np.zeros(0, np.uint64)
    return [
        none if n == 0 else np.unique(rolled[a : a + n - WORDS + 1]) if n >= WORDS else hashed(h[a : a + n], n)
        for a, n in zip(starts.tolist(), lengths.tolist())
    ]


def shingles(text: bytes | None) -> np.ndarray:
    return shingle_sets([text])[0]


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a shingle set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s) & 0xFFFFFFFF)).astype(np.int64))


def band(n: np.ndarray) -> np.ndarray:
    """Sizes whose ratio allows similarity lie in one band or in adjacent ones."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(100 / PERCENT) + 1e-9).astype(np.int32)


def bitmap(s: np.ndarray) -> bytes:
    """A bit for every shingle's hash, in the power of two of bits that is at least twice the set's size, and ``LEAST_BITS``."""
    bits = max(LEAST_BITS, 1 << int(2 * len(s) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bytes over the same hashes."""
    return np.bitwise_or.reduce(x.reshape(-1, size), 0)


def may_link(na, nb, missing_a, missing_b):
    """Whether sets of these sizes can be similar if so many shingles of each are known to miss in the other."""
    most = np.minimum(na - missing_a, nb - missing_b)
    return 100 * most >= PERCENT * (na + nb - most)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact: whether two sorted arrays are similar."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def sets(docs: DataFrame) -> DataFrame:
    """kind 0: doc_id, n and set_key of every row; kind 1: frequent shingles of a task (in set_key) and their count (in n)."""

    def run(batches):
        import pyarrow as pa

        names = ["kind", "doc_id", "n", "set_key"]
        held, size, seen = [], 0, set()

        def often():
            found = np.concatenate(held)
            held.clear()
            found.sort()
            start = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
            counts = np.diff(np.append(start, len(found)))
            start, counts = start[counts >= LOCAL], counts[counts >= LOCAL]
            values = found[start].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(values), np.int32)), pa.nulls(len(values), pa.int64()), pa.array(counts.astype(np.int64)), pa.array(values)], names=names)

        for batch in batches:
            ids, data = batch.column(0), batch.column(1).to_pylist()
            for a, b in batches_by_size(data, 2_000_000):
                found = shingle_sets(data[a:b])
                keys = [set_key(s) for s in found]
                for k, s in zip(keys, found):
                    if k not in seen:
                        seen.add(k)
                        low = s[: np.searchsorted(s, COUNTED)].copy()
                        held.append(low)
                        size += len(low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(b - a, np.int32)), ids.slice(a, b - a), pa.array(np.array([len(s) for s in found], np.int64)), pa.array(np.array(keys, np.int64))],
                    names=names,
                )
                if size > COUNT_HELD:
                    yield often()
                    held, size, seen = [], 0, set()
        if held:
            yield often()

    return written(texts(docs).mapInArrow(run, "kind int, doc_id long, n long, set_key long"), "sets")


def frequent(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles that come last in the order, ``MOST_HEAVY`` at most."""
    counted = rows.where("kind = 1").groupBy("set_key").agg(F.sum("n").alias("n")).where(F.col("n") >= HEAVY)
    top = counted.orderBy(F.desc("n"), "set_key").limit(MOST_HEAVY).select("set_key").toArrow().column(0)
    return np.sort(top.to_numpy().astype(np.int64).view(np.uint64))


def signatures(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """set_key, n, band, bitmap and the first shingles in the global order of every set, mostly once for each task that meets it."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        import pyarrow as pa

        late, met = shared.value, set()
        for batch in batches:
            data = batch.column(1).to_pylist()
            for a, b in batches_by_size(data, 2_000_000):
                seen = {}
                if len(met) > KEYS_HELD:
                    met.clear()
                for s in shingle_sets(data[a:b]):
                    if len(s) and (key := set_key(s)) not in met:
                        met.add(key)
                        n = len(s)
                        first = n - -(-PERCENT * n // 100) + 1
                        if len(late):
                            at = np.searchsorted(late, s)
                            at[at == len(late)] = 0
                            last = late[at] == s
                            s, own = np.concatenate([s[~last], s[last]])[:first], s
                        else:
                            s, own = s[:first], s
                        seen[key] = (n, bitmap(own), s.view(np.int64))
                sizes = np.array([x[0] for x in seen.values()], np.int64)
                starts = np.cumsum([0] + [len(x[2]) for x in seen.values()])
                flat = np.concatenate([x[2] for x in seen.values()]) if seen else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(seen), pa.int64()), pa.array(sizes), pa.array(band(sizes)),
                        pa.array([x[1] for x in seen.values()], pa.binary()), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat)),
                    ],
                    names=["set_key", "n", "band", "bits", "first"],
                )

    return written(texts(docs).mapInArrow(run, "set_key long, n long, band int, bits binary, first array<long>"), "signatures")


def stars(postings: DataFrame) -> DataFrame:
    """kind 0: a node and one of the first two nodes of its tile, or the first of the next smaller band's tile (x, y).
    kind 1: shingle, node and band (x, y, z) of the tiles that these pairs don't cover.

    Rows come sorted by shingle, band and node; a shingle's rows are held until
    it is complete, or up to ``HOLD`` rows, of which no tile is covered anyway.
    """

    def run(batches):
        import pyarrow as pa

        def out(t, b, k, hot):
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (b[1:] != b[:-1]) | (k[1:] != k[:-1])
            t, b, k = t[fresh], b[fresh], k[fresh]
            tile = np.ones(len(t), bool)
            tile[1:] = (t[1:] != t[:-1]) | (b[1:] != b[:-1])
            start = np.flatnonzero(tile)
            own = np.cumsum(tile) - 1
            place = np.arange(len(t)) - start[own]
            one, two = k[start], k[np.minimum(start + 1, len(k) - 1)]
            before = np.zeros(len(start), bool)
            before[1:] = (t[start[1:]] == t[start[:-1]]) & (b[start[1:]] == b[start[:-1]] + 1)
            later, third, lower = place > 0, place > 1, before[own]
            x = np.concatenate([k[later], k[third], k[lower]])
            y = np.concatenate([one[own[later]], two[own[third]], one[own[lower] - 1]])
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            new = x != y
            new[1:] &= (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            x, y = x[new], y[new]
            token = np.ones(len(t), bool)
            token[1:] = t[1:] != t[:-1]
            first = np.flatnonzero(token)
            of = np.cumsum(token) - 1
            size = np.diff(np.append(first, len(t)))
            bands = np.bincount(of[start], minlength=len(first))
            crowded = ((size > 3) | ((size == 3) & (bands > 1)))[of]
            if hot is not None:
                crowded |= t == hot
            t, b, k = t[crowded], b[crowded].astype(np.int64), k[crowded]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([0, 1], np.int32), [len(x), len(t)])), pa.array(np.concatenate([x, t])), pa.array(np.concatenate([y, k])), pa.array(np.concatenate([np.zeros(len(x), np.int64), b]))],
                names=["kind", "x", "y", "z"],
            )

        held, hot = None, None
        for batch in batches:
            t, b, k = (c.to_numpy() for c in batch.columns)
            if held is not None:
                t, b, k = (np.concatenate([x, y]) for x, y in zip(held, (t, b, k)))
            if not len(t):
                continue
            last = int(np.searchsorted(t, t[-1]))
            if len(t) - last < HOLD:
                held = t[last:], b[last:], k[last:]
                if last:
                    yield out(t[:last], b[:last], k[:last], hot)
                    hot = None if t[last] != hot else hot
                continue
            hot = t[-1]
            yield out(t, b, k, hot)
            # the first nodes of the last two tiles go on, so that what follows meets them too
            tiles = np.flatnonzero(np.append(True, b[last + 1 :] != b[last:-1])) + last
            keep = {len(t) - 1}
            for x in tiles[-2:].tolist():
                keep |= {x, *(x + np.flatnonzero(k[x:] != k[x])[:1]).tolist()}
            keep = sorted(keep)
            held = t[keep], b[keep], k[keep]
        if held is not None:
            yield out(*held, hot)

    tiles = postings.select("token", "band", "set_key").repartition("token").sortWithinPartitions("token", "band", "set_key")
    return written(tiles.mapInArrow(run, "kind int, x long, y long, z long"), "stars")


def bounded_edges(edges: DataFrame, signs: DataFrame) -> DataFrame:
    """The edges (a, b) whose bit counts allow similarity."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b, na, nb, x, y = batch.columns
            keep = []
            for n, m, p, q in zip(na.to_pylist(), nb.to_pylist(), x.to_pylist(), y.to_pylist()):
                p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
                size = min(len(p), len(q))
                p, q = folded(p, size), folded(q, size)
                keep.append(bool(may_link(n, m, int(np.bitwise_count(p & ~q).sum()), int(np.bitwise_count(q & ~p).sum()))))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = signs.select(F.col("set_key").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    two = signs.select(F.col("set_key").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    sized = edges.join(one, "a").join(two, "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    return sized.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")


def arrays(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """set_key and items, the sorted shingle array, of the rows of ``docs`` whose id is among ``reps`` (rep)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data = batch.column(1).to_pylist()
            for a, b in batches_by_size(data, 2_000_000):
                found = [s for s in shingle_sets(data[a:b]) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["set_key", "items"])

    rows = texts(docs)
    return rows.join(reps, rows["doc_id"].eqNullSafe(reps["rep"]), "left_semi").mapInArrow(run, "set_key long, items binary")


def verified(edges: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges (a, b) whose shingle arrays are similar; b is the side that many edges may share."""

    def compare(batches):
        import pyarrow as pa

        at, held = None, None
        for batch in batches:
            out = []
            for b, chunk, a, items in zip(*(c.to_pylist() for c in batch.columns)):
                s = np.frombuffer(items, np.uint64)
                if a is None:
                    at, held = (b, chunk), s
                elif at == (b, chunk) and linked(s, held):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    edges = written(edges.distinct(), "edges")
    release(docs.sparkSession)
    chunks = edges.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    members = edges.join(chunks, "b").select(F.col("a").alias("key"), "b", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int").alias("chunk"), "a")
    leaders = chunks.select(F.col("b").alias("key"), "b", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("a"))
    roles = small_side(members.unionByName(leaders), "roles")
    needed = nodes.join(edges.select(F.col("a").alias("set_key")).union(edges.select("b")).distinct(), "set_key")
    needed = small_side(needed.select("rep").distinct(), "needed")
    items = arrays(docs, needed)
    lines = items.join(roles, items["set_key"] == roles["key"]).select("b", "chunk", "a", "items")
    lines = lines.repartition("b", "chunk").sortWithinPartitions("b", "chunk", F.col("a").asc_nulls_first())
    links = written(lines.mapInArrow(compare, "a long, b long").distinct(), "links")
    release(docs.sparkSession)
    return links


def groups(postings: DataFrame) -> DataFrame:
    """lead, set_key, band, comp: the nodes of all crowded shingles that share their smallest node, once each.

    ``postings`` has token, set_key, band and comp. Two nodes with a common
    shingle share a group; shingles of one component's nodes are left out.
    """
    tokens = postings.groupBy("token").agg(F.min("set_key").alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return written(postings.join(tokens.select("token", "lead"), "token").select("lead", "set_key", "band", "comp").distinct(), "groups")


def central_edges(found: DataFrame, seed: int) -> DataFrame:
    """Nodes of large groups with a few nodes of their group's largest component: a, b.

    The component and its nodes, at most one of each of ``CENTRAL`` parts, are
    aggregates, so that a large group's nodes need not meet in one task.
    """
    hashed = found.withColumn("h", F.xxhash64("set_key", F.lit(seed)))
    parts = hashed.groupBy("lead", "comp", F.pmod("h", F.lit(CENTRAL)).alias("part")).agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("h", "set_key")).alias("c"))
    sizes = parts.groupBy("lead", "comp").agg(F.sum("size").alias("size"), F.collect_list("c.set_key").alias("center"))
    tops = sizes.groupBy("lead").agg(F.sum("size").alias("nodes"), F.max(F.struct("size", "comp", "center")).alias("t")).where(F.col("nodes") >= LARGE)
    tops = small_side(tops.select("lead", F.col("t.comp").alias("main"), F.col("t.center").alias("center")), "centers")
    return found.join(tops, "lead").where("comp <> main").select(F.col("set_key").alias("a"), F.explode("center").alias("b")).distinct()


def block_pairs(found: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs of one group's nodes in different components that bit counts allow: a, b.

    Groups are cut into blocks, and every pair of blocks is one unit.
    """

    def pairs(rows):
        out = set()
        n = np.array([r[3] for r in rows], np.int64)
        bands, blocks, comps, keys = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2, 4))
        across = blocks.min() != blocks.max()
        for own in np.unique(bands).tolist():
            # a band's nodes against each other and those of the next larger band, in bitmaps of one size
            at = np.flatnonzero((bands == own) | (bands == own + 1))
            size = min(len(rows[i][5]) for i in at)
            bits = np.stack([folded(np.frombuffer(rows[i][5], np.uint8), size) for i in at])
            m, c, k, bl, home = n[at], comps[at], keys[at], blocks[at], bands[at] == own
            for i in np.flatnonzero(home).tolist():
                fit = (c != c[i]) & (~home | (np.arange(len(at)) > i)) & (100 * np.minimum(m, m[i]) >= PERCENT * np.maximum(m, m[i]))
                if across:
                    fit &= bl != bl[i]
                js = np.flatnonzero(fit)
                if len(js):
                    x, y = bits[i], bits[js]
                    good = may_link(m[i], m[js], np.bitwise_count(x & ~y).sum(1, dtype=np.int64), np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
                    out.update((min(k[i], j), max(k[i], j)) for j in k[js[good]].tolist())
        return sorted(out)

    def run(batches):
        import pyarrow as pa

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        at, held = None, []
        for batch in batches:
            for lead, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (lead, i, j):
                    if len(held) > 1:
                        yield batch_of(pairs(held))
                    at, held = (lead, i, j), []
                held.append(row)
        if len(held) > 1:
            yield batch_of(pairs(held))

    blocks = small_side(found.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    rows = found.join(blocks, "lead").withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("lead", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "comp", "set_key")
    rows = rows.join(signs.select("set_key", "n", "bits"), "set_key").select("lead", "i", "j", "band", "block", "comp", "n", "set_key", "bits")
    units = rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    return units.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id and comp (the smallest id that edges (a, b) reach) of every id that has an edge.

    Every round joins each node to the smallest of its neighbours' smallest
    neighbours and contracts the edges, which at least halves the nodes.
    """
    edges = written(edges.where("a <> b").distinct(), "graph")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")), "least")
        up = least.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        step = written(least.join(up, "p").select(F.col("a").alias("id"), F.col("pp").alias("to")), "step")
        if labels is None:
            labels = step.select("id", F.col("to").alias("comp"))
        else:
            moved = step.select(F.col("id").alias("comp"), "to")
            labels = written(labels.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")
        one, two = step.select(F.col("id").alias("a"), F.col("to").alias("x")), step.select(F.col("id").alias("b"), F.col("to").alias("y"))
        edges = written(edges.join(one, "a").join(two, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "graph")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return labels


def labelled(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds comp: a node's component, itself where it has none."""
    return postings.join(labels.withColumnRenamed("id", "set_key"), "set_key", "left").withColumn("comp", F.coalesce("comp", "set_key"))


def similar(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): doc_id, n and set_key of every row; set_key and comp of every node that has a link.

    Of the tables that are written on the way only these two stay.
    """
    with scratch(docs.sparkSession) as keep, small_batches(docs.sparkSession):
        rows, labels = _similar(docs.select("doc_id", "text"))
        keep(rows, labels)
    return rows, labels


def _similar(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = sets(docs)
    nodes = rows.where("kind = 0 and n > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    signs_all = signatures(docs, frequent(rows))
    found = stars(signs_all.select("set_key", "band", F.explode("first").alias("token")))
    release(docs.sparkSession)
    edges = found.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    crowded = found.where("kind = 1").select(F.col("x").alias("token"), F.col("y").alias("set_key"), F.col("z").cast("int").alias("band")).distinct()
    met = edges.select(F.col("a").alias("set_key")).union(edges.select("b")).union(crowded.select("set_key")).distinct()
    signs = written(signs_all.select("set_key", "n", "bits").join(met, "set_key", "left_semi").dropDuplicates(["set_key"]), "signs")
    if files := signs_all.inputFiles():
        remove(docs.sparkSession, files[0].rsplit("/", 1)[0])
    release(docs.sparkSession)
    links = verified(bounded_edges(edges, signs), docs, nodes)
    labels = components(links)
    # large clouds of copies: their members that a first node missed meet nodes of the cloud's main component
    for seed in range(ROUNDS):
        found = groups(labelled(crowded, labels))
        edges = written(bounded_edges(central_edges(found, seed), signs), "central")
        if edges.isEmpty():
            break
        more = verified(edges, docs, nodes)
        links = links.union(more)
        labels = components(links)
    rest = verified(block_pairs(groups(labelled(crowded, labels)), signs), docs, nodes)
    if not rest.isEmpty():
        labels = components(links.union(rest))
    return rows.where("kind = 0").select("doc_id", "n", "set_key"), labels.withColumnRenamed("id", "set_key")


def similar_matrix(sets_: list[np.ndarray]) -> np.ndarray:
    """Exact: which of these shingle sets are similar to which; false on the diagonal.

    Common shingles are counted as products of incidence matrices, ``SLICE``
    columns at a time; shingles of one set alone are no columns.
    """
    k, n = len(sets_), np.array([len(s) for s in sets_], np.int64)
    values, column, times = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(k), n)
    shared = times[column] > 1
    place = np.cumsum(times > 1) - 1
    row, column = row[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((k, k), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, total, SLICE):
        a, b = np.searchsorted(column, [at, at + SLICE])
        part = np.zeros((k, min(SLICE, total - at)), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    out = 100 * both >= PERCENT * (n[:, None] + n[None, :] - both)
    np.fill_diagonal(out, False)
    return out


def link_counts(docs: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """set_key and links: to how many rows with another set a node of a component is linked.

    All pairs of a component's nodes are compared, which are all that can be
    linked, in blocks of about ``BLOCK`` nodes, fewer of long ones; a unit is a
    pair of blocks and gives one number per node, not the pairs.
    """

    def run(batches):
        import pyarrow as pa

        def counted(held):
            held = list({r[2]: r for r in held}.values())  # a node comes twice if its smallest id does
            block, copies = np.array([r[0] for r in held]), np.array([r[1] for r in held], np.int64)
            linked_ = similar_matrix([np.frombuffer(r[3], np.uint64) for r in held])
            if block.min() != block.max():
                linked_ &= block[:, None] != block[None, :]
            links = linked_ @ copies
            return pa.RecordBatch.from_arrays([pa.array([r[2] for r in held], pa.int64()), pa.array(links, pa.int64())], names=["set_key", "links"])

        at, held = None, []
        for batch in batches:
            for comp, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (comp, i, j):
                    if held:
                        yield counted(held)
                    at, held = (comp, i, j), []
                held.append(row)
        if held:
            yield counted(held)

    members = written(nodes.join(labels, "set_key"), "members")
    size = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_ITEMS)
    blocks = small_side(members.groupBy("comp").agg(F.ceil(size).cast("int").alias("blocks")), "member-blocks")
    items = arrays(docs, small_side(members.select("rep").distinct(), "members-needed"))
    rows = members.join(blocks, "comp").withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "copies", "set_key")
    units = rows.join(items, "set_key").select("comp", "i", "j", "block", "copies", "set_key", "items").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return written(units.mapInArrow(run, "set_key long, links long").groupBy("set_key").agg(F.sum("links").alias("links")), "link-counts")


def classified(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and set_key of every row; set_key is null without words."""
    ids = rows.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("own"))
    marked = ids.join(labels, "set_key", "left").withColumn("comp", F.coalesce("comp", "set_key"))
    smallest = marked.groupBy("comp").agg(F.min("own").alias("component_id"))
    named = marked.join(smallest, "comp").select("set_key", "component_id")
    return (
        rows.where("n > 0").join(named, "set_key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "set_key")
        .unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("set_key")))
    )


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row of ``docs``.

    A component's id is the smallest doc_id in it, n_links the number of other
    rows that a row is linked with. Rows without words, and null texts, have no
    shingles, no links and are their own component; of a text under five words
    the whole sequence is one shingle. Rows whose sets are equal are linked,
    repeated rows too; a null id is never the smallest, and a component of null
    ids alone has a null id. An empty table gives an empty result; other columns
    are ignored. Shingles, and sets, are told apart by 64-bit hashes.
    """
    docs = docs.select("doc_id", "text")
    rows, labels = similar(docs)
    with scratch(docs.sparkSession) as keep, small_batches(docs.sparkSession):
        nodes = rows.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
        links = link_counts(docs, nodes, labels)
        keep(links)
    release(docs.sparkSession)
    counts = nodes.join(links, "set_key", "left").select("set_key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return classified(rows, labels).join(counts, "set_key", "left").select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but for those that are linked with a smaller doc_id.

    Rows that share an id go or stay together, and a null id goes if a row of
    its component has one.
    """
    found = classified(*similar(docs))
    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__dropped_id")).distinct()
    dropped = small_side(dropped, "dropped")
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["__dropped_id"]), "left_anti")
