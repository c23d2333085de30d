"""Spelling variants: words one edit apart, found in a forward and a reversed sorted dictionary.

One inserted, deleted or replaced code point leaves the first or the second
half of a word intact. So the words of a pair share a block of the dictionary
that is sorted forwards (words that begin with the same half), or of the one
that is sorted backwards (words that end with the same half). A word lies in
the blocks of its own length, and in those of the length below, in which it may
be the longer one of a pair. A block that has more than ``BLOCK`` words is
subdivided in the same way: what its words don't share yet is halved again,
until a block is small or its words differ in one place only, of which there
are no more than the alphabet allows. Blocks are stretches of sorted rows; they
are scanned, and every pair is verified. A block takes the pairs whose common
prefix has a length of its own range, so that each pair counts once.

Defined results: null texts have no words; a null doc_id is the empty string in
the hash that decides on an edit; rows that repeat count as often as they come;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import scratch, small_side, written
from timberline.llm.exact_dedup import normalised

#: Letters of words, after A-Z are lower-cased.
LETTERS = "[a-z\\u00C0-\\u00FF]+"
#: Words have so many code points and occurrences at least; a form has so many times the occurrences of its variant.
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: Words of a block that are compared with each other; more are subdivided.
BLOCK = 256
#: Bytes of letters that are compared at once.
COMPARED = 16_000_000


def occurrences(docs: DataFrame, edit_every: int | None = 199) -> DataFrame:
    """Every occurrence (column word) of a run of letters; where ``edit_every`` divides the hash of id and run, one code point is deleted."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(normalised(F.col("text")), F.lit(LETTERS), F.lit(0))).alias("run"))
    if edit_every is None:
        return runs.select(F.col("run").alias("word"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % edit_every == 0, cut).otherwise(F.col("run")).alias("word"))


def dictionary(words: DataFrame) -> DataFrame:
    """The different words that are long and frequent enough, with their number of occurrences n."""
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


#: A block: length of the shorter words, number of code points shared at the beginning and at the end, these code points,
#: and the common prefix from which on a pair belongs to another block.
KEY = ["size", "head", "tail", "below", "first", "last"]


def _row(size, head, tail, below):
    """A word's row in a block; the word is sorted as it is read in the block's dictionary."""
    return [
        size.alias("size"), head.alias("head"), tail.alias("tail"), below.alias("below"),
        F.substring("word", F.lit(1), head).alias("first"), F.when(tail > 0, F.substring("word", F.length("word") - tail + 1, tail)).otherwise(F.lit("")).alias("last"),
        F.when(tail > 0, F.reverse("word")).otherwise(F.col("word")).alias("sorted"), "word", "n",
    ]


def halves(words: DataFrame) -> DataFrame:
    """Rows of the first blocks: each word by its first and its second half, as the shorter and as the longer word of a pair."""
    sized = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("s")).where(F.col("s") >= LEAST_LENGTH)
    s = F.col("s")
    half = F.floor(s / 2).cast("int")
    zero = F.lit(0)
    return sized.select(*_row(s, half, zero, s + 1)).unionByName(sized.select(*_row(s, zero, s - half, half)))


def subdivided(rows: DataFrame) -> DataFrame:
    """Rows of large blocks in smaller ones: the first or the second half of what a block's words don't share yet is intact too."""
    size, head, tail, below = (F.col(f"_{c}") for c in KEY[:4])
    old = rows.select(*(F.col(c).alias(f"_{c}") for c in KEY[:4]), "word", "n")
    rest = size - head - tail
    half = F.floor(rest / 2).cast("int")
    early = old.where(head + half < below).select(*_row(size, head + half, tail, below))
    return early.unionByName(old.select(*_row(size, head, tail + rest - half, F.least(below, head + half))))


def blocks(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """Rows of all blocks, none larger than ``most`` unless its words differ in one place only."""
    rows, out = written(halves(words), "halves"), None
    while True:
        sizes = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > most) & (F.col("size") - F.col("head") - F.col("tail") >= 2))
        large = small_side(sizes.select(*KEY), "large-blocks")
        small = rows.join(large, KEY, "left_anti")
        out = small if out is None else out.unionByName(small)
        if large.isEmpty():
            return out
        rows = written(subdivided(rows.join(large, KEY, "left_semi")), "subdivided")


def scanned(block: np.ndarray, size: int, head: np.ndarray, below: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places one edit apart among words of ``size`` or one more code points, each pair within a block, whose common prefix is in its block's range."""
    n = len(words)
    data = [x.encode("latin-1") for x in words]
    length = np.array([len(x) for x in data])
    letters = np.frombuffer(b"".join(x.ljust(size + 1, b"\0") for x in data), np.uint8).reshape(n, size + 1)
    one, two = [], []
    step = max(1, COMPARED // (size + 1))
    left = np.arange(n)
    for apart in range(1, n):
        left = left[left + apart < n]
        left = left[block[left] == block[left + apart]]
        if not len(left):
            break
        for i in range(0, len(left), step):
            a = left[i : i + step]
            b = a + apart
            swap = length[a] > length[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            a, b = a[length[a] == size], b[length[a] == size]
            x, y = letters[a], letters[b]
            equal = x == y
            prefix = np.where(equal.all(1), size + 1, equal.argmin(1))
            longer = length[b] > size
            ok = (prefix >= head[a]) & (prefix < below[a])
            # replaced: one place differs; inserted: what follows the prefix comes one place later
            same = ok & ~longer & ((~equal).sum(1) == 1)
            more = np.flatnonzero(ok & longer)
            shifted = (x[more, :size] == y[more, 1:]) | (np.arange(size)[None, :] < prefix[more, None])
            same[more[shifted.all(1)]] = True
            one.append(a[same])
            two.append(b[same])
    none = np.zeros(0, np.int64)
    return (np.concatenate(one), np.concatenate(two)) if one else (none, none)


def near(rows: DataFrame) -> DataFrame:
    """For every word that has near words: their number n_near, and the most frequent of them (struct best: n negated, word)."""

    def run(batches):
        import pyarrow as pa

        def out(size, block, head, below, words, n):
            best: dict[str, list] = {}
            a, b = scanned(block, size, head, below, words)
            for x, y in zip([*a.tolist(), *b.tolist()], [*b.tolist(), *a.tolist()]):
                new = (-n[y], words[y])
                old = best.get(words[x])
                if old is None:
                    best[words[x]] = [1, new]
                else:
                    old[0] += 1
                    old[1] = min(old[1], new)
            found = best.values()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.string()), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1][0] for x in found], pa.int64()), pa.array([x[1][1] for x in found], pa.string())],
                names=["word", "n_near", "minus_n", "other"],
            )

        def starts(rows):
            new = np.ones(len(rows[0]), bool)
            new[1:] = False
            for c in rows[: len(KEY)]:
                new[1:] |= c[1:] != c[:-1]
            return np.flatnonzero(new)

        def done(rows, new):
            # whole blocks, those of one size at once
            size, head, _, below, _, _, words, n = rows
            block = np.zeros(len(size), np.int64)
            block[new] = 1
            block = np.cumsum(block)
            cuts = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), len(size)]
            for a, b in zip(cuts, cuts[1:]):
                yield out(int(size[a]), block[a:b], head[a:b], below[a:b], words[a:b].tolist(), n[a:b].tolist())

        held = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(held, rows)]
            if not len(rows[0]):
                continue
            new = starts(rows)
            n = int(new[-1])
            if n:
                yield from done([x[:n] for x in rows], new[:-1])
            held = [x[n:] for x in rows]
        if held is not None:
            yield from done(held, starts(held))

    names = [*KEY, "word", "n"]
    dealt = rows.repartition(*KEY).sortWithinPartitions(*KEY, "sorted").select(*names)
    found = dealt.mapInArrow(run, "word string, n_near long, minus_n long, other string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "other")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form: forms are followed to the last, twice as far each time.

    A form is at least ``TIMES`` times as frequent, so there are few steps and no circles.
    """
    ways = written(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = small_side(ways.select(F.col("word").alias("root"), F.col("root").alias("further")), "further")
        longer = written(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        ways = longer.select("word", "root")


def grouped(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a dictionary (word, n)."""
    with scratch(words.sparkSession) as keep:
        words = written(words, "dictionary")
        found = near(blocks(words, most))
        form_n = -F.col("best.minus_n")
        is_form = form_n >= TIMES * F.col("n")
        rows = written(
            words.join(found, "word", "left").select(
                "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, form_n).alias("form_n")
            ),
            "forms",
        )
        ends = small_side(roots(rows.where("form is not null")), "roots")
        out = written(rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants")
        keep(out)
    return out


def variants(docs: DataFrame) -> DataFrame:
    """``grouped`` over the words of all texts."""
    return grouped(dictionary(occurrences(docs)))
