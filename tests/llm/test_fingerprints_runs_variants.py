"""Fingerprints, periodic runs and spelling variants against brute force, and on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_llm_operators import awkward, awkward_rows, empty  # noqa: F401
from timberline.llm import periodic_runs, queries, simhash, spelling

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


# ---- fingerprints -----------------------------------------------------------


def votes_by_hand(text):
    """The bits of a text, term by term and bit by bit."""
    terms = Counter(simhash.term_hashes([text.encode()])[0].tolist())
    sums = [0] * 256
    for term, n in terms.items():
        weight = int(np.rint(simhash.PARTS * (1 + np.log(n))))
        data = b"".join(simhash._mixed(np.array([term], np.uint64) + s).tobytes() for s in simhash._SEEDS)
        for i in range(256):
            sums[i] += weight if data[i // 8] >> (7 - i % 8) & 1 else -weight
    return "".join(f"{sum((sums[8 * i + j] > 0) << (7 - j) for j in range(8)):02x}" for i in range(32))


def by_hand(rows):
    """Result rows (without n_near) of rows whose ids differ."""
    rows = [(k, t or "") for k, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))]
    out = []
    for (k, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        m = len(t) // 3
        changed = t[: len(t) - m] + u[:m]
        a, b, c = (simhash.fingerprints([x.encode()])[0] for x in (t, changed, u))
        alike = [round(float(max(np.cos(np.pi * np.unpackbits(a ^ x).sum() / 256), 0)), 9) for x in (b, c)]
        out.append((k, len(t), hashlib.sha256(changed.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), *alike))
    return sorted(map(repr, out))


def results(df):
    return sorted(repr((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))) for r in df.collect())


@pytest.mark.parametrize("text", ["", "one", "a b c d", "To be or not to be or not to be that is", "é ﬁ \x1c \U0001f600 x\ty\x0bz"])
def test_fingerprint_bit_by_bit(text):
    got = simhash.fingerprints([b"before it", text.encode(), b"behind"])[1].tobytes().hex()
    assert got == (votes_by_hand(text) if text.split() else "0" * 64)


def test_fingerprint_of_parts_at_once(monkeypatch):
    text = " ".join(f"w{i * i % 701}" for i in range(900)).encode()
    whole = simhash.fingerprints([text])
    monkeypatch.setattr(simhash, "TERMS", 100)
    assert (simhash.fingerprints([text]) == whole).all()


def test_fingerprints_over_ranges(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = queries.QUERIES["op11_simhash_fingerprints"](spark, sf_dir)
    assert results(got) == by_hand(rows)
    near = [(r.near_edited, r.near_next) for r in got.collect()]
    assert np.mean([a > b for a, b in near]) > 0.97 and np.mean([a for a, _ in near]) - np.mean([b for _, b in near]) > 0.4


def test_fingerprints_of_awkward_rows(spark, awkward, empty):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = simhash.fingerprinted(awkward)
    assert results(got) == by_hand(rows)
    equal = {}
    for r in got.collect():
        assert equal.setdefault(dict((k, (t or "").translate(UPPER)) for k, t in rows)[r.doc_id], r.fingerprint) == r.fingerprint
    assert simhash.fingerprinted(empty).count() == 0
    one = simhash.fingerprinted(spark.createDataFrame([(7, "a b c d e f g h i")], DOCS)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].n_near == 0


@pytest.mark.parametrize("tile", [3, 4096])
def test_near_search_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    r = np.random.default_rng(5)
    centres = r.integers(0, 256, (12, 32), np.uint8)
    prints = []
    for c in centres:
        for _ in range(15):
            bits = np.unpackbits(c)
            bits[r.choice(256, r.integers(0, 9), replace=False)] ^= 1
            prints.append(np.packbits(bits))
    raw = np.unique(np.stack(prints), axis=0)
    d = np.array([[np.unpackbits(a ^ b).sum() for b in raw] for a in raw])
    for radius in (3, 7, 15):
        want = {x.tobytes().hex(): int(n) for x, n in zip(raw, (d <= radius).sum(1) - 1) if n}
        df = spark.createDataFrame([(x.tobytes().hex(),) for x in raw], "fingerprint string")
        got = {x.fingerprint: x.n_near for x in simhash.near_counts(df, radius).collect()}
        assert got == want and want


# ---- runs -------------------------------------------------------------------


def runs_by_hand(w):
    """Every stretch of every period, grown word by word; of equal stretches the smallest period."""
    best = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((a, n, q) for (a, n), q in best.items())


def row_by_hand(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        a = h // 10 % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        old = list(w)
        for i in range(a, len(w)):
            w[i] = old[a + (i - a) % p]
    runs = runs_by_hand(w)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


def repeating(rng, most):
    """Words with repetitions of their ends and copies of their parts."""
    k, w = rng.choice([1, 2, 2, 3, 4]), []
    while len(w) < most:
        c = rng.random()
        if c < 0.4 and w:
            unit = w[-rng.randint(1, min(len(w), 12)) :]
            w += (unit * rng.randint(1, 7))[: rng.randint(1, 50)]
        elif c < 0.6 and w:
            a = rng.randrange(len(w))
            w += w[a : a + rng.randint(1, 40)]
        else:
            w += [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 6))]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_all_periods(seed):
    """With texts cut at rare words, and with whole texts going through the suffix array."""
    rng = random.Random(seed)
    for _ in range(80):
        docs = [repeating(rng, rng.randint(1, 90)) for _ in range(rng.randint(1, 5))]
        want = [runs_by_hand(w) for w in docs]
        codes = periodic_runs._Codes()
        flat = np.array([codes[x] for w in docs for x in w])
        doc = np.repeat(np.arange(len(docs)), [len(w) for w in docs])
        begins = np.cumsum([0] + [len(w) for w in docs])
        for at, piece in (periodic_runs.pieces(flat, doc), (np.arange(len(flat)), doc)):
            got = [[] for _ in docs]
            for a, b, q in periodic_runs.runs(flat[at], piece):
                got[doc[at[a]]].append((int(at[a] - begins[doc[at[a]]]), b - a, q))
            assert [sorted(x) for x in got] == want


def test_previous_factors():
    rng = random.Random(9)
    for _ in range(50):
        docs = [repeating(rng, rng.randint(1, 60)) for _ in range(3)]
        flat = np.array([int(x) for w in docs for x in w])
        piece = np.repeat(np.arange(3), [len(w) for w in docs])
        length, source = periodic_runs.Suffixes(flat, piece).previous_factors()
        first = 0
        for w in docs:
            for i in range(len(w)):
                common = lambda j: next((k for k in range(len(w) - i) if w[j + k] != w[i + k]), len(w) - i)  # noqa: E731, B023
                assert length[first + i] == max(map(common, range(i)), default=0)
                assert not length[first + i] or common(source[first + i] - first) == length[first + i]
            first += len(w)


def test_runs_query(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect())
    short = {r.doc_id: r.text for r in rows if len(r.text or "") < 6_000}
    assert len(got) == len(rows)
    assert [g for g in got if g[0] in short] == sorted(row_by_hand(k, t) for k, t in short.items())
    assert sum(g[1] > 0 for g in got) >= 5


def test_runs_of_awkward_rows(spark, awkward, empty):  # noqa: F811
    got = sorted((tuple(r) for r in periodic_runs.find(awkward, periodic_runs.with_repetition).collect()), key=repr)
    want = {repr(row_by_hand(r[0], r[1])) for r in awkward_rows() if len(r[1] or "") < 9_000}
    assert want <= set(map(repr, got)) and len(got) == len(awkward_rows())
    assert periodic_runs.find(empty).count() == 0
    long = [(1, "x " * 100_000), (2, "a b " * 50_000 + "c"), (3, " ".join(str(i % 1000) for i in range(4_500)))]
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in periodic_runs.find(spark.createDataFrame(long, DOCS)).collect()}
    assert got == {1: (1, 0, 100_000, 1), 2: (1, 0, 100_000, 2), 3: (1, 0, 4_500, 1000)}


# ---- variants ---------------------------------------------------------------


def one_apart(a, b):
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return (a[p + 1 :] if len(a) == len(b) else a[p:]) == b[p + 1 :]


def variants_by_hand(counts):
    """All pairs that share a code point deletion, compared."""
    met = {}
    for w in counts:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            met.setdefault(x, []).append(w)
    near = {w: set() for w in counts}
    for group in met.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 5 * counts[w]:
            form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w))))
    return sorted(map(repr, out))


def counted_by_hand(rows):
    counts = Counter()
    for k, text in rows:
        for x in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            x = x.translate(UPPER)
            h = zlib.crc32(f"{'' if k is None else k}:{x}".encode())
            counts[x if h % 199 else x[: h % len(x)] + x[h % len(x) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


FIELDS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("most", [2, 5, 256])
def test_variants_against_all_pairs(spark, most):
    """Blocks of any size, words that differ at every place, long words, and forms of forms."""
    rng, counts = random.Random(most), {"b" * 6 + "c" * i: 5 * 6**i for i in range(5)}
    while len(counts) < 400:
        word = list(rng.choice(list(counts))) if rng.random() < 0.8 else [rng.choice("abé") for _ in range(rng.randint(6, 40))]
        i, c = rng.randrange(len(word)), rng.random()
        if c < 0.3:
            word[i] = rng.choice("abÿz")
        elif c < 0.6:
            word.insert(i, rng.choice("abé"))
        elif len(word) > 6:
            del word[i]
        counts.setdefault("".join(word), int(5 * 10 ** (3 * rng.random())))
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(repr(tuple(r[f] for f in FIELDS)) for r in spelling.grouped(df, most).collect()) == variants_by_hand(counts)


def test_variants_query(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_spelling_variants"](spark, sf_dir)
    assert sorted(repr(tuple(r[f] for f in FIELDS)) for r in got.collect()) == variants_by_hand(counted_by_hand(rows))


def test_variants_of_awkward_rows(spark, awkward, empty):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = spelling.variants(awkward)
    assert sorted(repr(tuple(r[f] for f in FIELDS)) for r in got.collect()) == variants_by_hand(counted_by_hand(rows))
    assert spelling.variants(empty).count() == 0
    odd = [(i, " ".join(["Straße× straßen", "x" * 3000, "x" * 2999 + "ÿ", "İstanbul"] * (6 if i else 40))) for i in range(3)] + [(None, "abcdefg " * 9)]
    got = spelling.variants(spark.createDataFrame(odd, DOCS))
    assert sorted(repr(tuple(r[f] for f in FIELDS)) for r in got.collect()) == variants_by_hand(counted_by_hand(odd))
