"""Periodic runs of words, and texts without their repetitions.

A run is a stretch of words that repeats with a smallest period q, at least
four times and over six words, and that no neighbouring word extends. All runs
of a document are enumerated from its Lempel-Ziv blocks:

1. Suffixes are sorted by doubling ranks, whose levels also give the common
   extension of any two places, forwards and backwards.
2. The longest previous factor of a place is the larger of its extensions with
   the nearest smaller places before and after it in the suffix array.
3. Blocks follow from these factors: each is the longest one at its place.
4. A run that touches a block's boundary is found by extending both ways from
   the boundary, for every period up to the lengths of the blocks beside it.
5. A run within a block is a copy of one within the block's earlier occurrence;
   runs are kept sorted by start, and blocks are gone through from left to right.

Words of a run come at least four times in it. So a text is first cut at words
that come less often in their piece, again until nothing changes, and what is
left goes through these steps. No run is lost or gained by a cut: a rare word
beside a run can't extend it.

Defined results: a null text has no words, as has one of white space. A null
doc_id leaves the words as they are. Rows that repeat get equal results, other
columns are ignored, an empty table gives an empty result. A text is worked on
as a whole, in one task.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right, insort
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import batches_by_size

#: A run has at least this many words and repeats its period at least so often.
LEAST, TIMES = 6, 4


def with_repetition(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the evaluation's edit: for a tenth of the ids, the tail repeats its first words."""
    n, h = len(words), zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    unit = words[a : a + p]
    return words[:a] + unit * times + unit[:rest]


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def pieces(codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in a run, and the number of each one's piece: neighbours in a text whose words all come often enough in the piece."""
    at = np.arange(len(codes))
    piece = doc.astype(np.int64)
    while len(at):
        _, key, counts = np.unique(piece * (int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True)
        often = counts[key] >= TIMES
        stays, of = at[often], piece[often]
        new = np.ones(len(stays), bool)
        new[1:] = (stays[1:] != stays[:-1] + 1) | (of[1:] != of[:-1])
        of = np.cumsum(new) - 1
        long = np.bincount(of)[of] >= LEAST if len(of) else np.zeros(0, bool)
        stays, of = stays[long], of[long]
        if len(stays) == len(at):
            break
        at, piece = stays, of
    return at, np.unique(piece, return_inverse=True)[1] if len(at) else piece


class Suffixes:
    """Ranks of all stretches of 1, 2, 4, ... symbols of several strings, which lie one behind the other and never share a stretch."""

    def __init__(self, codes: np.ndarray, piece: np.ndarray):
        n = len(codes)
        self.codes, self.piece = codes, piece
        last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True))
        first = np.append(0, last[:-1] + 1)
        self.first, self.end = first[piece], last[piece] + 1
        rank = np.unique(piece * (int(codes.max()) + 1) + codes, return_inverse=True)[1]
        self.levels, size = [rank.astype(np.int32)], 1
        while int(rank.max()) < n - 1:
            following = np.zeros(n, np.int64)
            inside = np.flatnonzero(np.arange(n) + size < self.end)
            following[inside] = rank[inside + size] + 1
            rank = np.unique(rank * (n + 1) + following, return_inverse=True)[1]
            self.levels.append(rank.astype(np.int32))
            size *= 2
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from a on equal those from b on."""
        out = np.zeros(len(a), np.int64)
        end = np.minimum(self.end[np.minimum(a, len(self.end) - 1)], self.end[np.minimum(b, len(self.end) - 1)])
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + out, b + out
            inside = np.flatnonzero((x < end) & (y < end))
            rank = self.levels[k]
            same = inside[rank[x[inside]] == rank[y[inside]]]
            out[same] += 1 << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many symbols before a equal those before b, not beyond ``first``; a < b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - out - (1 << k), b - out - (1 << k)
            inside = np.flatnonzero(x >= first)
            rank = self.levels[k]
            same = inside[rank[x[inside]] == rank[y[inside]]]
            out[same] += 1 << k
        return out

    def previous_factors(self) -> tuple[np.ndarray, np.ndarray]:
        """For every place: the length of the longest stretch that also begins at an earlier place of its string, and such a place."""
        n, order = len(self.codes), self.order
        length, source = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for step in (-1, 1):
            near = np.arange(n) + step
            todo = np.flatnonzero((near >= 0) & (near < n))
            while len(todo):
                todo = todo[order[near[todo]] > order[todo]]
                near[todo] = near[near[todo]]
                todo = todo[(near[todo] >= 0) & (near[todo] < n)]
            has = np.flatnonzero((near >= 0) & (near < n))
            here, there = order[has], order[near[has]]
            own = self.piece[here] == self.piece[there]
            here, there = here[own], there[own]
            common = self.forward(there, here)
            better = common > length[here]
            length[here[better]], source[here[better]] = common[better], there[better]
        return length, source


def blocks(length: np.ndarray, first: int, end: int) -> list[int]:
    """Starts of a string's Lempel-Ziv blocks: longest previous factors, or single new symbols."""
    out, at = [], first
    while at < end:
        out.append(at)
        at += max(1, int(length[at]))
    return out


def _counted(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each owner, repeated, and 1, 2, ... up to its size."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1


def boundary_runs(s: Suffixes, bound: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) that touch a boundary, given the lengths of the blocks before and after each; periods may be multiples."""
    n, out = len(s.codes), []
    string = np.minimum(bound, n - 1)
    inside = (bound < n) & (after > 0)
    string[~inside] = bound[~inside] - 1
    first, end = s.first[string], s.end[string]
    for right in (False, True):
        # a period's worth of the run lies before the boundary, or behind it
        owner, q = _counted(np.minimum(after, end - bound) if right else np.minimum(before + after, bound - first))
        for i in range(0, len(owner), 1 << 20):
            o, p = owner[i : i + (1 << 20)], q[i : i + (1 << 20)]
            x = bound[o]
            a, b = (x, x + p) if right else (x - p, x)
            lead = (b < end[o]) & (s.codes[np.minimum(a, n - 1)] == s.codes[np.minimum(b, n - 1)])
            trail = (a > first[o]) & (s.codes[np.maximum(a - 1, 0)] == s.codes[b - 1])
            may = np.flatnonzero(lead | trail)
            o, p, a, b = o[may], p[may], a[may], b[may]
            ahead = np.where(b < end[o], s.forward(a, np.minimum(b, n - 1)), 0)
            back = s.backward(a, b, first[o])
            size = p + ahead + back
            ok = size >= np.maximum(LEAST, TIMES * p)
            out.append(np.stack([a[ok] - back[ok], b[ok] + ahead[ok], p[ok]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def runs(codes: np.ndarray, piece: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, end, smallest period) of strings that lie one behind the other, sorted."""
    if not len(codes):
        return []
    s = Suffixes(codes, piece)
    length, source = s.previous_factors()
    lengths = length.tolist()
    firsts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
    ends = np.append(firsts[1:], len(codes))
    cut = [blocks(lengths, a, b) for a, b in zip(firsts.tolist(), ends.tolist())]
    bound, before, after = [], [], []
    for starts, end in zip(cut, ends.tolist()):
        sizes = [b - a for a, b in zip(starts, [*starts[1:], end])]
        bound += [*starts[1:], end]
        before += sizes
        after += [*sizes[1:], 0]
    touching = boundary_runs(s, *(np.array(x, np.int64) for x in (bound, before, after)))
    # of equal stretches the smallest period counts
    touching = touching[np.lexsort((touching[:, 2], touching[:, 1], touching[:, 0]))]
    smallest = np.ones(len(touching), bool)
    smallest[1:] = (touching[1:, :2] != touching[:-1, :2]).any(1)
    touching = touching[smallest]
    out = []
    at = np.searchsorted(touching[:, 0], firsts)
    for starts, end, lo, hi in zip(cut, ends.tolist(), at.tolist(), [*at[1:].tolist(), len(touching)]):
        if lo == hi:
            continue
        found = [tuple(x) for x in touching[lo:hi].tolist()]
        known = set(found)
        for x, t in zip(starts, [*starts[1:], end]):
            if t - x < LEAST + 2:
                continue
            origin = int(source[x])
            shift = x - origin
            i = bisect_right(found, (origin, len(codes) + 1, 0))
            while i < len(found) and found[i][0] < origin + t - x:
                a, b, p = found[i]
                if b < origin + t - x and (copy := (a + shift, b + shift, p)) not in known:
                    known.add(copy)
                    insort(found, copy)
                i += 1
        out += found
    return out


def analysed(words: list[list[bytes]]) -> list[tuple]:
    """For each text's words: number of runs, the longest run's start, length, period and exponent, digest of the runs, digest of the words that stay."""
    codes = _Codes()
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(codes.__getitem__, chain.from_iterable(words)), np.int64, int(lengths.sum()))
    doc = np.repeat(np.arange(len(words)), lengths)
    begins = np.cumsum(lengths) - lengths
    at, piece = pieces(flat, doc)
    by_doc: dict[int, list] = {}
    for a, b, p in runs(flat[at], piece):
        d = int(doc[at[a]])
        by_doc.setdefault(d, []).append((int(at[a] - begins[d]), b - a, p))
    out = []
    for d, w in enumerate(words):
        found = sorted(by_doc.get(d, ()), key=lambda r: (r[0], r[2]))
        best = (None,) * 4
        if found:
            start, length, period = max(found, key=lambda r: (r[1], -r[0], -r[2]))
            best = start, length, period, 1000 * length // period
            change = np.zeros(len(w) + 1, np.int64)
            for start, length, period in found:
                change[start + period] += 1
                change[start + length] -= 1
            covered = np.cumsum(change[:-1]) > 0
            w = [x for x, c in zip(w, covered.tolist()) if not c]
        listed = "".join(f"{a},{n},{p}\n" for a, n, p in found)
        out.append((len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(w)).hexdigest()))
    return out


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def find(docs: DataFrame, prepare=None) -> DataFrame:
    """One row per row of ``docs``: its runs, longest run and digests (``SCHEMA``); ``prepare(words, doc_id)`` may change a text's words before."""

    def run(batches):
        import pyarrow as pa

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            ids, data = batch.column(0), batch.column(1).to_pylist()
            keys = ids.to_pylist()
            for a, b in batches_by_size(data, 2_000_000):
                words = [(x or b"").split() for x in data[a:b]]
                if prepare is not None:
                    words = [prepare(w, k) for w, k in zip(words, keys[a:b])]
                columns = list(zip(*analysed(words)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])], names=names
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
