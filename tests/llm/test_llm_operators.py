"""Each operator against brute force, an exact round trip or held-out accuracy, and on awkward tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import timberline
from timberline.llm import exact_dedup, flac, html_extract, mixing, ngram_join, packing, pii, quality, queries, rans, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names that operators use.
CLASH = ["score", "predicted", "held_out", "sha", "keep", "rows", "kept", "ids", "start", "length", "shard", "key", "part", "cut", "whole", "set_key", "n", "band", "media", "label", "__stat_log_chars", "__stat_row", "__mix_l", "__mix_m_whole", "__mix_domain", "_t", "listed", "lead", "__dedup_file", "__dedup_row", "file", "row", "_text", "bytes", "keep_id", "comp", "component_id", "__dropped_id", "rep", "items", "kind", "name", "domain", "capacity", "piece", "sequence_id", "offset", "fingerprint", "word", "form", "root", "n_runs", "period"]
WORDS = [f"w{i}" for i in range(400)]


def words(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(WORDS, n))


def awkward_rows():
    long = words(1, 30_000)
    base = words(2, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, None, "en", "src0", None), (2, "", "en", "src0", 0), (3, "   \n\t ", None, "src1", 5), (4, base, "en", None, 1), (5, base.upper(), "en", "src0", 1),
        (6, " ".join(near), "de", "src0", 1), (7, long, "en", "src0", 1), (8, long, "en", "src0", 1), (8, long, "en", "src0", 1), (None, "no id here at all", "en", "src2", 1),
        (9, "one two", "en", "src0", 1), (10, "One  two", "en", "src0", 1), (11, "Schöne Grüße, ﬁn \U0001f600 x@y.example +1 (323) 555-9830", "de", "src3", 1),
        (12, base, "en", "src0", 1), (2**40, "é" * 700 + " 4111 1111 1111 1111, 10.0.0.255", "fr", "src0", 1),
    ]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    timberline.importable(spark)
    df = spark.createDataFrame(awkward_rows(), DOCS)
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    path = f"file://{tmp_path_factory.mktemp('awkward')}/documents.parquet"
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, awkward):
    return awkward.where("doc_id = -1")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(1, 13)] + [(None, 1, 1), (4, None, None), (4, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return queries.table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def local(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# 1 ------------------------------------------------------------------------------------------------


def brute_components(rows):
    """[(id, text)] -> [(id, number of shingles, component, number of links)], by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted((r[0] if r[0] is not None else -1, len(s), (smallest[find(i)] if s else r[0]) or -1, links[i]) for i, (r, s) in enumerate(zip(rows, sets)))


def linked(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id or -1, r.n_links) for r in ngram_join.linked_documents(df).collect())


def test_ngram_join_on_awkward_rows(awkward, empty):
    assert linked(awkward) == brute_components([(r[0], r[1]) for r in awkward_rows()])
    assert linked(empty) == []


def test_ngram_join_matches_brute_force(spark):
    r = np.random.default_rng(5)
    rows, k = [], 0
    for group in range(25):
        base = list(r.choice(WORDS, int(r.integers(3, 90))))
        for _ in range(int(r.integers(1, 9))):
            text = list(base)
            for _ in range(int(r.integers(0, 4))):
                text[int(r.integers(0, len(text)))] = f"x{int(r.integers(0, 30))}"
            rows.append((k, " ".join(text[: len(text) - int(r.integers(0, 3))])))
            k += 1
    passage = " ".join(r.choice(WORDS, 60))
    rows += [(k + i, passage + " " + words(100 + i, 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert linked(df) == brute_components(rows)


def test_ngram_join_hands_python_little_text_at_once(spark, monkeypatch):
    from timberline.llm.common import small_batches

    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, write = spark.conf.get(name), ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, *a: (seen.append(spark.conf.get(name)), write(df, *a))[1])
    rows = [(k, words(k // 2, 30) + " end" * (k % 2)) for k in range(12)]
    assert linked(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)
    assert set(seen) == {f"{4 << 20}b"} and spark.conf.get(name) == before

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(b)])], names=["n"])

    with small_batches(spark):
        got = spark.range(0, 10, 1, 1).selectExpr("repeat('x', 1000000) AS text").mapInArrow(sizes, "n long").collect()
    assert sum(r.n for r in got) == 10 and max(r.n for r in got) <= 5


def test_signatures_of_equal_texts_come_once_from_a_task(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 1)
    try:
        df = spark.createDataFrame([(k, words(3, 20)) for k in range(5)], "doc_id long, text string").coalesce(1)
        assert ngram_join.signatures(df, np.zeros(0, np.uint64)).count() == 1
    finally:
        spark.conf.set(name, before)


def test_links_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    monkeypatch.setattr(ngram_join, "SLICE", 16)
    r = np.random.default_rng(8)
    base, rows = list(r.choice(WORDS, 70)), []
    for k in range(40):
        text = list(base)
        for _ in range(k % 3):
            text[int(r.integers(0, len(text)))] = f"x{int(r.integers(0, 9))}"
        rows.append((k, " ".join(text)))
    assert linked(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_tiles_cover_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOLD", 4)
    r = np.random.default_rng(3)
    rows = [(t, int(k) % 3, int(k)) for t in range(60) for k in r.choice(40, int(r.integers(1, 14)), replace=False)]
    out = ngram_join.stars(spark.createDataFrame(rows, "token long, band int, set_key long")).collect()
    edges = {frozenset((x.x, x.y)) for x in out if x.kind == 0}
    crowded = {(x.x, x.y) for x in out if x.kind == 1}
    for t, b, k in rows:
        for t2, b2, k2 in rows:
            if t == t2 and k < k2 and abs(b - b2) <= 1:
                assert frozenset((k, k2)) in edges or {(t, k), (t, k2)} <= crowded


def test_bitmap_bound_is_safe():
    r = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(r.integers(0, 2**63, int(r.integers(1, 200)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(r.integers(0, len(a) + 1))], r.integers(0, 2**63, int(r.integers(0, 60)), dtype=np.uint64)]))
        if not len(b):
            continue
        x, y = (np.frombuffer(ngram_join.bitmap(s), np.uint8) for s in (a, b))
        size = min(len(x), len(y))
        x, y = ngram_join.folded(x, size), ngram_join.folded(y, size)
        fits = ngram_join.may_link(len(a), len(b), int(np.bitwise_count(x & ~y).sum()), int(np.bitwise_count(y & ~x).sum()))
        exact = 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
        assert ngram_join.linked(a, b) == exact and (fits or not exact)


# 2 and 4 ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def larger(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, d, "documents"), queries.table(spark, d, "labels")
    return docs, labels


def held_out_scores(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    assert all(zlib.crc32(str(r).encode()) % 5 == 0 for r in [x.doc_id for x in scored.where("held_out").select("doc_id").limit(50).collect()])
    positive = [r.predicted for r in rows if r[1] == 1]
    negative = [r.predicted for r in rows if r[1] == 0]
    return sum(positive) / len(positive), sum(negative) / len(negative)


def test_quality_on_held_out_rows(larger):
    docs, labels = larger
    hit, false = held_out_scores(quality.scored(docs, quality.train(docs, labels)), labels, "quality")
    assert hit > 0.97 and false < 0.1


def test_toxicity_on_held_out_rows(larger):
    docs, labels = larger
    model = toxicity.train(docs, labels)
    out = toxicity.scored(docs, model).cache()
    hit, false = held_out_scores(out, labels, "toxic")
    assert hit > 0.82 and false < 0.02
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    spans = [(texts[r.doc_id][s.start : s.end], s.score) for r in out.where("size(offending) > 0").limit(50).collect() for s in r.offending]
    assert spans and all(score >= 0.5 and not set(".!?\n") & set(text) for text, score in spans)


def test_classifiers_on_awkward_rows(awkward, empty, labels):
    n = len(awkward_rows())
    q = quality.train(awkward, labels)
    rows = quality.scored(awkward, q).collect()
    assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert quality.scored(empty, q).count() == 0 and quality.accepted(awkward, q).columns == awkward.columns
    constant = quality.train(awkward, labels.where("quality = 1"))
    assert {r.predicted for r in quality.scored(awkward, constant).collect()} == {1}
    t = toxicity.train(awkward, labels)
    rows = toxicity.scored(awkward, t).collect()
    assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (1, 2)) and toxicity.scored(empty, t).count() == 0
    assert quality.scored(awkward, quality.train(awkward, labels.where("doc_id < 0"))).count() == n


def test_training_never_sees_held_out_labels(spark, docs, labels):
    from timberline.llm.common import training_sample

    got = {r.doc_id: r.label for r in training_sample(labels, "quality", 100).collect()}
    assert set(got) == {i for i in range(1, 13) if zlib.crc32(str(i).encode()) % 5} and got.get(4, 0) == 0
    assert training_sample(labels, "quality", 3).count() == 3


def test_rules_are_compiled_as_they_hold(larger, spark):
    """The column expression against the rules' own evaluation on the statistics."""
    from timberline.llm import quality

    docs, labels = larger
    docs = docs.where("doc_id < 1500")
    model = quality.train(docs, labels)
    names, weighted, intercept = model
    assert weighted
    got = {r.doc_id: r.score for r in quality.scored(docs.select("doc_id", "text"), model).select("doc_id", "score").collect()}
    stats = docs.select("doc_id", *(c.alias(k) for k, c in quality.statistics(F.col("text")).items())).collect()
    x = np.array([[r[k] for k in names] for r in stats])
    margin = intercept + sum(w * quality.holds(x, p) for p, w in weighted)
    np.testing.assert_allclose([got[r.doc_id] for r in stats], 1 / (1 + np.exp(-margin)), rtol=1e-9)
    # the lasso's weights are where its objective can't be lowered: smooth gradient within the penalty
    r = np.random.default_rng(1)
    z = (r.random((400, 12)) < 0.4).astype(float)
    y = (r.random(400) < 1 / (1 + np.exp(-(2 * z[:, 0] - 2 * z[:, 1])))).astype(float)
    w, b = quality.lasso(z, y, 0.01, 4000)
    g = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - y) / 400
    assert (np.abs(g) <= 0.01 + 1e-4).all() and np.allclose(g[w != 0], -0.01 * np.sign(w[w != 0]), atol=1e-4) and (w == 0).any()


def test_toxicity_scores_match_brute_force(spark):
    """Every sentence scored by hand, and the noisy-or of all; length alone doesn't count."""
    model = ({"vile": 11.0, "vile-": 2.0, "awful": 6.0, "nast-": 9.0}, -10.0)
    texts = [None, "", "...", "vile", "Nasty thing. A vile, VILE day! awful", "awful\n" * 40, "clean words. " * 100_000, "vilely so. " + "x. " * 20_000, words(3, 5000) + ". nastier", "nast"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.scored(df, model).collect():
        none, spans = 1.0, []
        sentences = [(m.start(), m.end()) for m in re.finditer(r"[^.!?\n]+", texts[r.doc_id] or "")]
        if sentences:
            none *= 1 - 1 / (1 + np.exp(10.0))
        for a, b in sentences:
            found = {f for w in re.findall(r"\w+", texts[r.doc_id][a:b].lower()) for f in (w, w[:4] + "-" if len(w) > 4 else w, w[:5] + "-" if len(w) > 5 else w) if f in model[0]}
            if found:
                p = 1 / (1 + np.exp(10.0 - sum(model[0][f] for f in found)))
                none *= 1 - p
                if p >= 0.5:
                    spans.append((a, b))
        assert r.score == pytest.approx(1 - none, abs=1e-9), r.doc_id
        assert [(x.start, x.end) for x in r.offending] == spans and r.predicted == int(r.score >= 0.5)
        assert r.doc_id != 6 or r.score < 1e-3


# 3 ------------------------------------------------------------------------------------------------


def test_exact_dedup_against_brute_force(docs, local):
    groups = defaultdict(list)
    for i, x in local.items():
        groups[lowered(x)].append(i)
    want = {(i, max(g), len(g), i == max(g), hashlib.sha256(x.encode()).hexdigest()) for x, g in groups.items() for i in g}
    got = exact_dedup.dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(local)


def test_exact_dedup_on_awkward_rows(awkward, empty):
    rows = exact_dedup.dedup(awkward).collect()
    assert len(rows) == len(awkward_rows()) and sum(r.kept for r in rows) == len({lowered(r[1]) for r in awkward_rows()})
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[4][0].keep_id == 12 and by[5][0].keep_id == 12 and by[4][0].group_size == 3 and by[1][0].keep_id == 2
    assert sorted(r.kept for r in by[8]) == [False, True] and by[None][0].kept and by[None][0].keep_id is None
    kept = exact_dedup.distinct_texts(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r.kept for r in rows)
    assert exact_dedup.dedup(empty).count() == 0 and exact_dedup.distinct_texts(empty).count() == 0


def test_exact_dedup_compares_full_bytes(awkward, monkeypatch):
    """With a digest that collides, groups are those of the full texts."""
    want = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(awkward).collect()}
    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.substring(real(c, n), 1, 0))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(awkward).collect()} == want


def test_dedup_state_takes_up_where_it_ended(spark, tmp_path):
    schema = spark.createDataFrame([], "doc_id long, sha string, bytes long, __dedup_file string, __dedup_row long").schema
    path, checkpoint = f"file://{tmp_path}/d", f"file://{tmp_path}/ck"
    row = lambda i, sha: (i, sha, 1, "f", i)
    spark.createDataFrame([row(1, "a"), row(2, "b")], schema).write.parquet(path)
    exact_dedup.stream_state(spark, path, schema, checkpoint)
    spark.createDataFrame([row(5, "a"), row(3, "a"), row(4, "c")], schema).write.mode("append").parquet(path)
    state = exact_dedup.stream_state(spark, path, schema, checkpoint)
    assert {(r.sha, r.keep.doc_id, r.rows) for r in state.collect()} == {("a", 5, 3), ("b", 2, 1), ("c", 4, 1)}


# 5 ------------------------------------------------------------------------------------------------


def test_mixing_budgets(spark):
    rows = [(i, " ".join(["x"] * 10), "en", f"src{i % 3}", 0) for i in range(300)] + [(1000 + i, " ".join(["x"] * 10), "de", "src10", 0) for i in range(5)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(df, 0.5, 1).collect()
    total = sum(r.n_tokens for r in out)
    assert total <= 1525 and total > 1525 - 10 * 8 and all(r.epoch == 0 for r in out)
    crawl = sum(r.n_tokens for r in out if r.domain == "crawl")
    assert sum(r.n_tokens for r in out if r.domain == "forum") == 50  # all it has; the rest went to its siblings
    assert crawl == pytest.approx((1525 - 50) * 40 / 75, abs=15)
    twice = mixing.mix(df, 2.0, 2).collect()
    assert len(twice) == 2 * len(rows)
    assert mixing.mix(df, 0.5, 1).count() == len(out)


def test_mixing_takes_another_tree(spark):
    import duckdb

    tree = mixing.Tree("CASE WHEN source LIKE 'it''s%' THEN 'a' ELSE 'b' END", {"a": 3, "b": 1}, {"en": 2}, {"it's 1": 5}, seed=3)
    rows = [(i, " ".join(["x"] * (1 + i % 9)), ["en", "de", None][i % 3], ["it's 1", "it's 2", "other", None][i % 4], 0) for i in range(600)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(map(repr, map(tuple, mixing.mix(df, 0.7, 2, tree).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens").collect())))
    duck = duckdb.connect()
    duck.sql("CREATE TABLE t (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    want = duck.sql(mixing.oracle(0.7, 2, "t", tree)).select("doc_id, domain, lang, source, epoch, n_tokens").fetchall()
    assert got == sorted(map(repr, want)) and len(got) > 100


def test_mixing_on_awkward_rows(awkward, empty):
    out = mixing.mixed(awkward, 3.0, 3)
    assert set(awkward.columns) <= set(out.columns) and out.where("__mix_m_whole <> 'clash' OR __mix_l <> 'clash'").count() == 0
    assert out.select(*awkward.columns).count() == 3 * len(awkward_rows()) - 2  # the source without tokens comes once
    assert mixing.mix(empty).count() == 0


# 6 ------------------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PATTERNS = [
    ("email", EMAIL), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in PATTERNS:
        for m in p.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.c.@d.e", "x@y", "a@b.c@d.e", ".@d.e a@b..c a@-.- %@1.2", "1.2.3.4.5.6.7.8 0001.2.3.4 256.1.1.1 1.2.3.4444 999999999999999999999.1.1.1", "4111111111111111 4111-1111 1111-1111 4111--1111 41111111111111110000 0000000000000",
    "+1 (323) 555-9830 +12 +123456789 +1234567890123456 ++4 555 555 5555.", "\U0001f600 é a@b.co 😀 +49 30 1234567 1.1.1.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 " * 30, "9" * 5000, "a" * 5000, "a@" * 2000, "1." * 3000, "+1" + " " * 3000, "a@b.c" * 300,
]


def test_pii_base_spans_match_brute_force(spark, docs, local):
    rows = [(i, x) for i, x in enumerate(TRICKY)] + [(1000 + i, x) for i, x in local.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    for i, x in rows:
        want = base_spans(x)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k, _ in PATTERNS], x[:80]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in pii.BASE] == want


def test_pii_adds_secrets(spark):
    secrets = [f'Use token = "{hashlib.sha1(str(i).encode()).hexdigest()}" here, {words(i, 9)}' for i in range(40)] + [f"key AKIA{i:04d}ABCDEFGHIJKL end" for i in range(1000, 1020)]
    df = spark.createDataFrame(list(enumerate(secrets + [words(i, 50) for i in range(100, 140)])), "doc_id long, text string")
    got = pii.find(df).collect()
    assert all("secret:" in r.spans for r in got if r.doc_id < 60) and all(not r.spans for r in got if r.doc_id >= 60)


def test_pii_gazetteer_names_and_lists(spark):
    named = [f"we met Maria Stolz{chr(97 + i % 26)} there, {words(i, 9)}" for i in range(30)]
    mails = [f"write to a{i}@b.com or call +49 30 12345{i:02d} now" for i in range(30)]
    plain = [f"Under Ground {words(100 + i, 20)}. The Big House" for i in range(30)]
    rows = [*named, *mails, *plain]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.candidates(df).collect()}
    assert all([(x.kind, x.value[:11], x.listed) for x in found[i].more_spans] == [("name", "Maria Stolz", True)] for i in range(30))
    assert all([x.listed for x in found[i].base_spans] == [True, True] for i in range(30, 60)) and not any(found[i].more_spans for i in range(60, 90))
    got = {r.doc_id: r.spans for r in pii.find(df).collect()}
    assert all(got[i] == f"name:7:{7 + len('Maria Stolzx')}" for i in range(30)) and not any(got[i] for i in range(60, 90))
    none = pii.GAZETTEERS | {"names": ()}
    assert not any(r.spans for r in pii.find(df.where("doc_id < 30"), gazetteers=none).collect())


def test_pii_on_awkward_rows(awkward, empty):
    rows = pii.find(awkward).collect()
    assert len(rows) == len(awkward_rows())
    by = {r.doc_id: r for r in rows}
    assert by[11].n_email == 1 and by[11].n_phone == 1 and by[2**40].n_card == 1 and by[2**40].n_ip == 1 and by[1].spans == ""
    assert pii.find(empty).count() == 0


# 7 and 9 ------------------------------------------------------------------------------------------


def token_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [np.array(e.ids + [1], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_pieces(rows, ids, capacity=4096):
    """rows of pack(), ids by doc: every id once and in place, sequences gapless and within capacity."""
    by, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
        assert r.length <= capacity
    assert set(by) == set(ids)
    for doc, pieces in by.items():
        for r in pieces:
            assert zlib.crc32(ids[doc][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.start == r.piece * capacity
        assert len(pieces) == -(-len(ids[doc]) // capacity)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_id_encoder_equals_the_library():
    import random

    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from timberline.llm.common import IdEncoder, slices_by_size

    rng = random.Random(5)
    parts = [
        "Hello", "w\u00f6rld", "\u00c9T\u00c9", "don't", "IT'S", "'s", "a'", "x...", "!!", "\u0301", "e\u0301", "\u00a0", " ", "\u0085", "\x1c", "\u0130stanbul", "\u0391\u03a3", "\u4e2d\u6587", "1234", "\u00b2",
        "\u00aa", "\u00df", "\u1e9e", "\t", "\n", "\r\n", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "A<|endoftext|>b", "A\u030a", "\ufb01", "%%%", "word,", "Word.", "\U0001f600", "_x_", "\x00", "\u200d", "\u212a",
    ]
    texts = [None, "", " ", "\n"] + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for name, by_words in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        library, encoder = Tokenizer.from_file(path), IdEncoder(path, 500)
        assert encoder.by_words == by_words
        for _ in range(2):
            ids, bounds = encoder.encode(pa.array(texts, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        ids, bounds = encoder.encode(pa.array([], pa.string()))
        assert len(ids) == 0 and bounds.tolist() == [0]
    column = pa.array(["a" * n if n else None for n in (5, 0, 3, 20, 1, 1)], pa.string())
    assert list(slices_by_size(column, 7)) == [(0, 3), (3, 4), (4, 6)] and list(slices_by_size(column[:0])) == []


def test_packing(docs, local):
    ids = dict(zip(local, token_ids(local.values())))
    used = check_pieces(packing.pack(docs, queries.tokenizer_path()).collect(), ids)
    assert used <= 1.02 * sum(map(len, ids.values())) / 4096 + 1


def test_packing_on_awkward_rows(awkward, empty):
    rows = packing.pack(awkward, queries.tokenizer_path()).collect()
    texts = dict((r[0], r[1]) for r in awkward_rows())
    assert sum(r.doc_id == 8 for r in rows) == 2 * sum(r.doc_id == 7 for r in rows)
    ids = dict(zip(texts, token_ids(texts.values())))
    assert all(zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


def test_pack_sizes_takes_the_smallest_growth():
    r = np.random.default_rng(2)
    sizes = r.integers(1, 50, 300)
    bins, offsets = packing.pack_sizes(sizes, 50)
    level, counts = [], defaultdict(int)
    for i in np.argsort(-sizes, kind="stable"):
        s = sizes[i]

        def growth(gap, s=s):
            after = dict(counts)
            if gap < 50:
                after[gap] -= 1
            if gap > s:
                after[gap - s] = after.get(gap - s, 0) + 1
            return sum(x * x for x in after.values())

        options = sorted({50, *(g for g, n in counts.items() if n > 0 and g >= s)})
        best = min(options, key=lambda g: (growth(g), g))
        assert 50 - offsets[i] == best
        if best < 50:
            counts[best] -= 1
        if best > s:
            counts[best - s] += 1
    assert (np.bincount(bins, sizes) <= 50).all() and not level


def test_rans_round_trip():
    r = np.random.default_rng(0)
    ids = (r.zipf(1.3, 50_000) % 49_000).astype(np.uint32)
    table = rans.Table(*np.unique(ids, return_counts=True))
    assert int(table.freq.sum()) == 1 << rans.SCALE and table.freq.min() >= 1
    for n in (1, 2, 63, 64, 65, 4097, len(ids)):
        assert (rans.decode_block(n, *rans.encode_block(ids[:n], table), table) == ids[:n]).all()
    lanes, states, coded = rans.encode_block(ids, table)
    entropy = -sum(c * np.log2(c / len(ids)) for c in np.unique(ids, return_counts=True)[1].tolist()) / 8
    assert len(coded) + len(states) < 1.05 * entropy + 8 * lanes
    with pytest.raises((ValueError, IndexError)):
        bad = bytearray(coded)
        bad[len(bad) // 2] ^= 1
        if (rans.decode_block(len(ids), lanes, states, bytes(bad), table) != ids).any():
            raise ValueError
    one = rans.Table(np.array([1]), np.array([9]))
    assert (rans.decode_block(999, *rans.encode_block(np.ones(999, np.uint32), one), one) == 1).all()


def test_rans_files(spark, docs, local, tmp_path):
    path = f"file://{tmp_path}/ids"
    rans.write_ids(docs, path, queries.tokenizer_path(), block_tokens=3000)
    rows = rans.starts(rans.read_ids(spark, path)).orderBy("start").collect()
    order = sorted(local)
    want = token_ids(local[i] for i in order)
    at = 0
    assert [r.doc_id for r in rows] == order
    for r, ids in zip(rows, want):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes())) and bytes(r.ids) == ids.tobytes()
        at += len(ids)
    damaged = spark.read.parquet(f"{path}/blocks").withColumn("words", F.expr("substring(words, 2)"))
    damaged.write.parquet(f"file://{tmp_path}/bad/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"file://{tmp_path}/bad/table")
    with pytest.raises(Exception, match="damaged"):
        rans.read_ids(spark, f"file://{tmp_path}/bad").count()


def test_rans_on_awkward_rows(spark, awkward, empty, tmp_path):
    path = f"file://{tmp_path}/ids"
    rans.write_ids(awkward, path, queries.tokenizer_path())
    rows = rans.starts(rans.read_ids(spark, path)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, *sorted(r[0] for r in awkward_rows() if r[0] is not None)] and rows[1].n_tokens == 1
    rans.write_ids(empty, f"{path}-none", queries.tokenizer_path())
    assert rans.read_ids(spark, f"{path}-none").count() == 0


# 8 ------------------------------------------------------------------------------------------------


def test_flac_round_trips():
    r = np.random.default_rng(1)
    payloads = [
        bytes(192), b"\xff" * 9600, r.integers(0, 256, 5760).astype(np.uint8).tobytes(), bytes(np.clip(128 + 100 * np.sin(np.arange(19200) / 9), 0, 255).astype(np.uint8)),
        flac.payload("hé")[1], flac.payload("a b c. " * 9000)[1], flac.payload(None)[1], r.integers(0, 3, 192 * 40).astype(np.uint8).tobytes(),
    ]
    streams = [flac.encode(x) for x in payloads]
    assert flac.decode_many(streams) == payloads
    stream = streams[5]
    meta = flac.Stream(stream)
    assert meta.rate == flac.RATE and meta.bps == 8 and meta.channels == 1 and meta.n == len(payloads[5]) and [p[0] for p in meta.points] == list(range(0, meta.n, flac.BLOCK))
    i = stream.index(b"\x83")
    size = int.from_bytes(stream[i + 1 : i + 4], "big")
    assert flac.decode_many([stream[:4] + b"\x80" + stream[5:i] + stream[i + 4 + size :]]) == [payloads[5]]  # without seek points
    for at in (meta.first + 2, meta.first + 40, len(stream) - 1):
        bad = bytearray(stream)
        bad[at] ^= 4
        with pytest.raises((ValueError, IndexError)):
            flac.decode_many([bytes(bad)])


def test_flac_codes_with_long_runs_of_zeros():
    r = np.random.default_rng(3)
    payloads = []
    for n in (192, 4096, 9600):
        x = np.full(n, 128, np.uint8)
        x[r.integers(0, n, n // 60)] = r.choice([1, 120, 135, 255], n // 60)
        payloads.append(x.tobytes())
    # in one buffer: codes that begin at every bit of a byte, with runs beyond one and several 32-bit windows
    assert flac.decode_many([flac.encode(x) for x in payloads]) == payloads
    bits = "1" + "0" * 7 + "1" + "0" * 31 + "1" + "0" * 32 + "1" + "0" * 100 + "1"
    data = np.packbits(np.array([*map(int, bits.ljust(-(-len(bits) // 8) * 8, "0")), *[0] * 64], np.uint8)).astype(np.uint32)
    windows = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    got = flac._zeros(windows, np.arange(len(bits), dtype=np.uint32))
    assert got.tolist() == [bits.index("1", i) - i for i in range(len(bits))]


def test_flac_checksums_against_bitwise_definitions():
    def crc(data, poly, width):
        c, top, mask = 0, 1 << (width - 1), (1 << width) - 1
        for b in data:
            c ^= b << (width - 8)
            for _ in range(8):
                c = ((c << 1) ^ poly) & mask if c & top else (c << 1) & mask
        return c

    for n in (0, 1, 7, 300, 5000):
        data = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
        assert flac.crc16(data) == crc(data.tolist(), 0x8005, 16) and flac.crc8(data.tobytes()) == crc(data.tolist(), 0x07, 8)
    for n in (0, 0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000, 0x10FFFF):
        assert flac._coded_number(n) == chr(n).encode("utf-8", "surrogatepass")


def test_flac_query(awkward, empty):
    rows = {(r.doc_id, r.n_bytes): r for r in flac.stored_and_read(awkward).collect()}
    for doc, text, *_ in awkward_rows():
        data = (text or "").encode()
        r = rows[(doc, len(data))]
        data = data.ljust(max(1, -(-len(data) // 192)) * 192)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]))
        assert r.media_sha256 == hashlib.sha256(flac.encode(data)).hexdigest() and r.feature == flac.feature(data)
    assert flac.stored_and_read(empty).count() == 0
    blocks = flac.pcm_blocks(flac.store(awkward.where("doc_id = 7")), 10_000).orderBy("block").collect()
    raw = b"".join(bytes(b.pcm) for b in blocks)
    assert [b.sample_offset for b in blocks] == list(range(0, len(raw), 10_000))
    assert (np.frombuffer(raw, np.uint8) ^ 0x80).tobytes() == flac.payload(next(r[1] for r in awkward_rows() if r[0] == 7))[1]


def test_flac_query_writes_streams_and_blocks(spark, awkward):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.iterdir())
    rows = {(r.doc_id, r.n_bytes): r for r in flac.stored_and_read(awkward, 10_000).collect()}
    tables = {p.name.split("-")[0]: spark.read.parquet(f"file://{p}") for p in set(shared.iterdir()) - before}
    assert set(tables) == {"media", "pcm"}
    texts = sorted((r[0] or -1, len((r[1] or "").encode())) for r in awkward_rows())
    media = tables["media"].collect()
    assert sorted((r.doc_id or -1, r.n_bytes) for r in media) == texts and len({r.row for r in media}) == len(media)
    blocks = {}
    for r in tables["pcm"].orderBy("row", "block").collect():
        blocks.setdefault(r.row, []).append(r)
    assert max(map(len, blocks.values())) > 2 and set(blocks) == {r.row for r in media}
    for m in media:
        own, want = blocks[m.row], rows[(m.doc_id, m.n_bytes)]
        raw = (np.frombuffer(b"".join(bytes(b.pcm) for b in own), np.uint8) ^ 0x80).tobytes()
        assert [b.sample_offset for b in own] == list(range(0, len(raw), 10_000)) and [raw] == flac.decode_many([bytes(m.media)])
        assert (want.payload_sha256, want.media_sha256, want.media_bytes) == (hashlib.sha256(raw).hexdigest(), hashlib.sha256(m.media).hexdigest(), len(m.media))
    with pytest.raises(Exception, match="missing or damaged"):
        flac.digests(tables["pcm"].where("block <> 1")).collect()


def plainly_decoded(stream: bytes) -> bytes:
    """A decoder after the format's description, bit by bit."""
    bits, at, n = "".join(f"{b:08b}" for b in stream), 0, int.from_bytes(stream[21:26], "big") & ((1 << 36) - 1)

    def read(width: int, signed: bool = False) -> int:
        nonlocal at
        value = int(bits[at : at + width] or "0", 2)
        at += width
        return value - (1 << width) if signed and value >> (width - 1) else value

    read(32)
    last = 0
    while not last:
        last = read(1)
        read(7)
        skip = 8 * read(24)
        at += skip
    out: list[int] = []
    while len(out) < n:
        assert read(15) == 0x7FFC
        read(1)
        size = read(4)
        read(12)
        lead = f"{read(8):08b}".index("0")
        at += 8 * max(0, lead - 1)
        size = 4096 if size == 12 else read(16) + 1
        read(9)
        kind = read(7) >> 1
        order = kind - 8 if 8 <= kind < 32 else kind - 31 if kind >= 32 else 0
        x = [read(8, True)] * size if kind == 0 else [read(8, True) for _ in range(size if kind == 1 else order)]
        if kind > 1:
            c, shift = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order if kind < 32 else 0], 0
            if kind >= 32:
                precision, shift = read(4) + 1, read(5)
                c = [read(precision, True) for _ in range(order)]
            parts = 1 << read(6)
            for part in range(parts):
                k = read(4)
                for _ in range(size // parts - (0 if part else order)):
                    zeros = bits.index("1", at) - at
                    at += zeros + 1
                    u = zeros << k | read(k)
                    x.append((u >> 1 ^ -(u & 1)) + (sum(a * b for a, b in zip(c, reversed(x))) >> shift))
        at = -(-at // 8) * 8 + 16
        out += x
    return bytes((v & 0xFF) ^ 0x80 for v in out)


def test_flac_streams_by_a_plain_decoder():
    r = np.random.default_rng(7)
    for n in (1, 5, 65, 192, 1535, 1536, 1728, 4096, 4300):
        i = np.arange(n)
        signals = [
            r.integers(0, 256, n), 128 + 100 * np.sin(i / 9), np.cumsum(r.integers(-3, 4, n)) % 256, np.where(r.random(n) < 0.01, r.integers(0, 256, n), 128),
            r.choice([32, 97, 101, 110, 116, 195, 169], n), i % 2 * 255, np.where(i < n - 1, 7, 200),
        ]
        for x in signals:
            raw = np.asarray(x).astype(np.uint8).tobytes()
            assert plainly_decoded(flac.encode(raw)) == raw


def test_flac_predictors_where_they_save_a_bit_of_a_sample():
    r = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in r.integers(0, 26, r.integers(2, 9))) for _ in range(300)]
    text = flac.payload(" ".join(words[i] for i in r.integers(0, 300, 8000)))[1]
    wave = bytes(np.clip(128 + 100 * np.sin(np.arange(19200) / 9), 0, 255).astype(np.uint8))
    marks = flac.payload("".join(chr(0x4E00 + i) for i in r.integers(0, 2000, 9000)))[1]

    def kinds(stream):
        meta = flac.Stream(stream)
        return [flac.parse_frame(stream, at, meta.bps).kind for at in meta.frame_starts(len(stream))]

    got = {x: flac.encode(x) for x in (text, wave, marks)}
    assert flac.decode_many(list(got.values())) == list(got)
    # Rice codes in any case: of the samples themselves for words, of what a predictor leaves for a wave
    assert set(kinds(got[text])[:-1]) == {8} and min(kinds(got[wave])) > 8  # a text's last frame may be short
    assert all(len(x) < 1.01 * len(raw) for raw, x in got.items()) and len(got[wave]) < len(wave) / 2


def test_flac_tables_of_words_take_less_than_their_texts(spark):
    from pathlib import Path

    r = np.random.default_rng(6)
    words = ["".join(chr(97 + c) for c in r.integers(0, 26, r.integers(2, 9))) for _ in range(300)]
    texts = [" ".join(words[i] for i in r.integers(0, 300, 700)) for _ in range(300)]
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.iterdir())
    rows = flac.stored_and_read(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.payload_sha256 for r in rows} == {i: hashlib.sha256(flac.payload(x)[1]).hexdigest() for i, x in enumerate(texts)}
    # streams and PCM blocks; with predicted codes, which are never equal for equal words, the streams alone take nearly as much as the texts
    size = sum(f.stat().st_size for p in set(shared.iterdir()) - before for f in p.glob("*.parquet"))
    assert size < 0.95 * sum(map(len, texts))


# 10 -----------------------------------------------------------------------------------------------

PAGE = """<html><body><header class="site"><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies, ok?</div><main><div class="post"><h2>T &amp; x</h2>
<p>One  two, three.<p>Four <b>five</b>, six.<ul><li>a, b</ul></div><aside>Side, bar.</aside><form>Name</form><section id="comments"><p>Nice, post! I really liked it, thanks.</p></section></main><footer>c</footer>"""
PAGES = [
    (PAGE, "T & x\nOne two, three.\nFour five, six.\na, b"), ("<p>plain", "plain"), ("", ""), (None, ""), ("just text &lt;b&gt;", "just text <b>"), ("<!-- x <p>hi", ""), ("<script>var t='</p>'", ""),
    ("<div id=content><p>Hello, world. This is it.</p><p>More text,\n here.</p></div><div class=ad><p>Buy now, please.</p></div>", "Hello, world. This is it.\nMore text, here."),
    ("<article><h1>T.</h1><p><b>T.<br><p>Body, text. " + "x, " * 40 + "</p></article><footer>&copy; y</footer>", "T.\nT.\nBody, text. " + ("x, " * 40).strip()),
    ("<p " * 200, ""), ("<article><p>cut, here &am", "cut, here &am"),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_main_text(page, want):
    assert html_extract.main_text(page) == want


def test_inline_links_stay_and_link_lists_go():
    inline = "".join(f"<p>See the <a href=/{i}>study {i}</a> and more, please.</p>" for i in range(4))
    links = "".join(f"<li><a href=/{i}>Other page {i}</a></li>" for i in range(4))
    heads = "".join(f"<h2><a href=#{i}>Part {i}</a></h2><p>Text of this part, number {i}.</p>" for i in range(3))
    want = "\n".join(f"See the study {i} and more, please." for i in range(4))
    assert html_extract.main_text(f"<article>{inline}<ul>{links}</ul><p><a>a</a> | <a>b</a> | <a>c</a></p></article>") == want
    assert html_extract.main_text(f"<article>{heads}</article>") == "\n".join(f"Part {i}\nText of this part, number {i}." for i in range(3))


def test_the_bound_of_an_article_holds_all_of_it():
    long = ("A long sentence, which goes on. " * 60).strip()
    assert html_extract.main_text(f"<div><h1>T</h1><p>{long}</p><p>Short one, here.</p></div>") == f"T\n{long}\nShort one, here."
    assert html_extract.main_text(f"<body><div class=lead><p>The lead, of some words.</p></div><div class=body><p>{long}</p></div></body>") == f"The lead, of some words.\n{long}"
    assert html_extract.main_text(f"<div><h2>T</h2><p>Intro, first.</p><ul><li>{long}</li><li>b</li></ul><pre>x, y.</pre></div>") == f"T\nIntro, first.\n{long}\nb\nx, y."
    assert html_extract.main_text(f"<main><div><p>The lead, of some words.</p></div><article><p>{long}</p></article></main>") == f"The lead, of some words.\n{long}"
    assert html_extract.main_text(f"<body><div><p>Some teaser, elsewhere.</p></div><article><p>{long}</p></article></body>") == long
    assert html_extract.main_text(f"<body><article><p>{long}</p></article><div>Some teaser, too.</div><article><p>Another, short one.</p></article></body>") == f"{long}\nAnother, short one."


def test_scripts_end_at_their_end_tags():
    for code in ("for(i=0;i<n;i++){f(i)}", "t='<!--'", "t='</p>'", "a<b&&c('\"')", "x='</scripts>'", "y=\"<a href='\"", "if(a<b){"):
        page = f"<SCRIPT>{code}</script ><style>p:after{{content:'<b'}}</STYLE><title>a <b</title><article><p>Hello, world.</p><svg><script>{code}</script></svg><p>And, more.</p></article>"
        assert html_extract.main_text(page) == "Hello, world.\nAnd, more."
    assert html_extract.main_text("<p>Kept, all.</p><script>never closed <p>x, y</p>") == "Kept, all."


def test_marks_do_not_take_the_article():
    body = "<p>Hello, world. This is it.</p><p>More text, here. And so on, and on.</p>"
    want = "Hello, world. This is it.\nMore text, here. And so on, and on."
    for name in ("layout has-sidebar", "no-ads", "with-comments", "post comments-open", "widget", "comments", "modal-content"):
        assert html_extract.main_text(f"<nav>x</nav><div class='{name}'><article>{body}</article></div>") == want
        assert html_extract.main_text(f"<nav>x</nav><div class='{name}'>{body}</div><footer>c</footer>") == want
    for attribute in ("data-id=nav", "data-class='ad'", "title=\"the class='ad'\"", "aria-role=banner"):
        assert html_extract.main_text(f"<article>{body}<div {attribute}>Short, kept.</div></article>") == want + "\nShort, kept."
    thread = "<div class=x><p>I really liked it, thanks.</p></div>" * 9
    for name in ("comments", "post-comments", "comment-list"):
        assert html_extract.main_text(f"<div class=post>{body}</div><section id={name}>{thread}</section>") == want
        assert html_extract.main_text(f"<article>{body}</article><section id={name}><article>Nice, yes.</article></section>") == want
    for name in ("ad", "site-header", "main-nav", "cookie-notice", "sidebar-left", "social-share-buttons", "related posts"):
        assert html_extract.main_text(f"<div>{body}<div class='{name}'>Buy, now.</div></div>") == want
    assert html_extract.main_text(f"<div class='cookie-notice'>{'We use cookies, ok? ' * 9}</div><article>{body}</article>") == want


def test_html_against_planted_articles(spark, sf_dir):
    import html

    pages = queries.table(spark, sf_dir, "pages")
    for r in pages.join(html_extract.extract(pages).withColumnRenamed("url", "u"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)


def test_html_on_awkward_rows(spark):
    df = spark.createDataFrame([(None, None, None, "c"), (1, "u", "<p>x</p>" * 20_000, "c"), (1, "u", "<p>x</p>", "c")], "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in html_extract.extract(df).collect()) == [0, 1, 39_999]
    assert html_extract.extract(df.where("page_id = 7")).count() == 0


def naive_ratios(paths, texts):
    """The path ratios with every window written out."""
    of = {p: [t for q, t in zip(paths, texts) if q == p] for p in paths}
    mean = {p: sum(map(len, v)) / len(v) for p, v in of.items()}
    marks = {p: (sum(sum(c in ".,;:!?\u2026\u3002\uff0c\u3001\uff1b\uff1a\uff01\uff1f\u00bf\u00a1" for c in t) for t in v) + 0.1) / len(v) for p, v in of.items()}

    def at(i, values):
        near = [j for j in range(len(paths)) if abs(i - j) <= 3]
        weight = [np.exp(-0.5 * (i - j) ** 2) for j in near]
        return sum(w * values[paths[j]] for w, j in zip(weight, near)) / sum(weight)

    fused = [np.sqrt(at(i, mean) * at(i, marks)) for i in range(len(paths))]
    return {p: max(f for f, q in zip(fused, paths) if q == p) for p in paths}, sum(fused) / len(fused)


def test_path_ratios_match_brute_force(spark, sf_dir):
    for r in queries.table(spark, sf_dir, "pages").limit(40).collect():
        page = html_extract.Page(r.html)
        texts = [(e, t) for e, _, t in page.texts if t.strip() and not page.junk[e]]
        paths = [page.path[e] for e, _ in texts]
        best, mean = html_extract.path_ratios(paths, [t for _, t in texts])
        want, level = naive_ratios(paths, [t for _, t in texts])
        assert best.keys() == want.keys() and all(best[p] == pytest.approx(want[p]) for p in want) and mean == pytest.approx(level)
        chosen = {p for p in want if want[p] >= 0.5 * level}
        assert html_extract.content_paths(page, [(e, 0, t) for e, t in texts]) <= chosen


LONG = "A paragraph of the text, with a mark or two. And another sentence, too."


@pytest.mark.parametrize(
    "page,want",
    [
        # without an article element: menu, comments and footer by their marks, the rest by its paths
        (f"<body><div class=top><a href=/>Home</a> <a href=/b>News</a> <a href=/c>Shop</a></div><div class=text><h1>Title</h1><p>{LONG}</p><ul><li>one</li><li>two</li></ul><p>{LONG}</p></div><div id=comments><p>{LONG} Me too.</p></div><div class=footer>Imprint</div></body>", f"Title\n{LONG}\none\ntwo\n{LONG}"),
        (f"<body><div class=intro><p>{LONG}</p></div><div class=text>{f'<p>{LONG}</p>' * 16}</div></body>", "\n".join([LONG] * 17)),
        # marked comments inside the article go, chapters that are only named like boilerplate stay
        (f"<article><p>{LONG}</p><section id=discussion><h2>Discussion</h2><p>{LONG}</p></section><p id=search-methods>{LONG}</p><section class=comments><p>{LONG}</p></section></article>", f"{LONG}\nDiscussion\n{LONG}\n{LONG}"),
        (f"<article><div class=entry-header><h1>Title</h1></div><p>Let <math>x</math> be. {LONG}</p></article>", f"Title\nLet x be. {LONG}"),
        # attributes as browsers read them
        (f"<article><p title=it's>{LONG}</p><p data-x='a>b' class=\"c>d\">{LONG}</p><p x=1 / y = \"2\" z>{LONG}</p></article>", "\n".join([LONG] * 3)),
        # blocks far from the text whose path lies below the threshold
        (f"<article><div class=x>12</div><div class=x>7</div><div class=x>3</div><div class=x>9</div><div class=x>8</div>{f'<p>{LONG * 4}</p>' * 9}</article>", None),
    ],
)
def test_content_is_selected_by_paths(page, want):
    got = html_extract.main_text(page)
    if want is None:
        assert got.endswith("\n".join([LONG * 4] * 9)) and "12" not in got.split("\n")
    else:
        assert got == want


@pytest.mark.parametrize("page", ["<div>" * 20_000 + LONG + "</div>" * 20_000, f"<div>{LONG}" * 20_000, f"<b>{LONG}" * 20_000, f"<p>{LONG}<span>" * 20_000, "<a " + "x='" * 50_000, "<a " + "x= " * 50_000 + "<p " * 50_000, "<" * 100_000])
def test_deep_and_broken_markup_takes_linear_time(page):
    import time

    html_extract.main_text(LONG)
    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 4


def test_noisy_or_fit_against_one_document_at_a_time(spark):
    """The fit's likelihood is the one written out document by document, and no small change of a weight raises it."""
    rng = np.random.default_rng(2)
    vocabulary = ["good", "fine", "vile", "foul", "rude"]
    docs, index = [], {w: i for i, w in enumerate(vocabulary)}
    for i in range(120):
        bad = i % 3 == 0
        pool = vocabulary if bad else vocabulary[:2] + ["rude"] * (i % 7 == 0)
        docs.append((i, int(bad), ". ".join(" ".join(rng.choice(pool, 3)) + " x" for _ in range(1 + i % 4))))
    sample = spark.createDataFrame(docs, "doc_id long, label int, text string")
    y, doc, sizes, cols = toxicity.bags(sample, index)
    assert y.tolist() == [d[1] for d in docs]
    patterns = [sorted({tuple(sorted({index[w] for w in s.split() if w in index})) for s in t.split(".")} - {()}) for _, _, t in docs]
    ends = np.cumsum(sizes)
    assert [(int(d), tuple(cols[e - s : e])) for d, s, e in zip(doc, sizes, ends)] == [(i, p) for i, ps in enumerate(patterns) for p in ps]

    def loss(w, b):
        total = 0.0
        for (_, label, _), ps in zip(docs, patterns):
            nothing = 1 - 1 / (1 + np.exp(-b))
            for p in ps:
                nothing *= 1 - 1 / (1 + np.exp(-min(max(b + sum(w[f] for f in p), -30), 30)))
            q = toxicity.NOISE + (1 - 2 * toxicity.NOISE) * (1 - nothing)
            total -= np.log(q if label else 1 - q)
        return total / len(docs)

    w, b = toxicity.fit(y, doc, sizes, cols, len(vocabulary))
    penalty = lambda x: 100 * toxicity.PENALTY * x.sum()
    at = loss(w, b)
    assert at < loss(np.full(5, toxicity.START), toxicity.FLOOR) - 0.3 and min(w[2], w[3]) > 5 > max(w[0], w[1])
    for f in range(5):
        for step in (-0.5, 0.5):
            other = w.copy()
            other[f] = max(0, other[f] + step)
            assert loss(other, b) + penalty(other) > at + penalty(w) - 0.02


def test_a_long_labelled_document_trains_with_all_its_patterns(spark):
    words_ = [f"t{i}" for i in range(1500)]
    sample = spark.createDataFrame([(1, 1, ". ".join(words_)), (2, 0, "nothing"), (3, 0, None)], "doc_id long, label int, text string")
    y, doc, sizes, cols = toxicity.bags(sample, {w: i for i, w in enumerate(words_)})
    assert y.tolist() == [1, 0, 0] and len(sizes) == 1500 and set(doc.tolist()) == {0} and sorted(cols.tolist()) == list(range(1500))


def test_operators_run_at_the_same_time(spark, awkward):
    """Three calls of the join in one session, in threads of their own, end with the same rows as one alone, and leave nothing behind."""
    from concurrent.futures import ThreadPoolExecutor

    rows = lambda: sorted(map(repr, map(tuple, ngram_join.linked_documents(awkward).collect())))
    want = rows()
    with ThreadPoolExecutor(3) as pool:
        assert [f.result() for f in [pool.submit(rows) for _ in range(3)]] == [want] * 3


def test_scratch_deletes_its_tables_if_it_fails(spark, awkward):
    import os

    from timberline.llm import common

    made = []
    with pytest.raises(RuntimeError), common.scratch(spark) as keep:
        made.append(common.written(awkward, "lost"))
        keep(made[0])
        raise RuntimeError
    with common.scratch(spark) as keep:
        made += [common.written(awkward, "kept"), common.written(awkward, "gone")]
        keep(made[1])
    there = [os.path.exists(x.inputFiles()[0].removeprefix("file://")) if x.inputFiles() else False for x in made]
    assert there == [False, True, False]


def test_exact_dedup_keeps_columns_of_any_name(spark):
    """Columns that are named like the operator's own, or like the locator of files, come back as they were."""
    names = ["__dedup_file", "__dedup_row", "___dedup_file", "_metadata", "file", "row", "keep"]
    rows = [(i, f"text {i % 3}", *(f"{n}{i}" for n in names)) for i in range(9)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    got = exact_dedup.distinct_texts(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(rows[6:])


TALK = "The committee met on Tuesday, and after a long debate, it agreed on the plan; nobody was surprised."


@pytest.mark.parametrize(
    "body,want",
    [
        (f'<div class="lead">A short lead, before all.</div><article><p>{TALK}</p><p>{TALK}</p><p>{TALK}</p></article>', ["A short lead, before all.", TALK, TALK, TALK]),
        (f'<article><p>{TALK}</p><h2>References</h2><ul><li><a href="/1">Smith, J.: On the plans of committees, 2nd ed., Oxford, 2001.</a></li><li><a href="/2">Jones, K.: Debates, and how they end, Leeds, 1999.</a></li>'
         f'<li><a href="/3">Brown, L.: Tuesdays, a history in five parts, York, 2010.</a></li></ul></article>',
         [TALK, "References", "Smith, J.: On the plans of committees, 2nd ed., Oxford, 2001.", "Jones, K.: Debates, and how they end, Leeds, 1999.", "Brown, L.: Tuesdays, a history in five parts, York, 2010."]),
        (f"<article><p>{TALK}</p><details><summary>More</summary>It was late.</details><div>So be it</div><p>{TALK}</p></article>", [TALK, "More", "It was late.", "So be it", TALK]),
        (f'<article><p>{TALK}</p><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li></ul><p>{TALK}</p></article>', [TALK, TALK]),
        (f'<div><div class="intro">Unlike others.</div><div><p>{TALK}</p><p>{TALK}</p></div></div><footer>Imprint</footer>', ["Unlike others.", TALK, TALK]),
        (f'<nav class="intro-menu"><a href="/">Home</a></nav><article><p>{TALK}</p></article><div class="comments"><p>{TALK}</p></div>', [TALK]),
    ],
    ids=["lead", "references", "details", "menu", "intro", "comments"],
)
def test_extraction_keeps_what_belongs_to_an_article(body, want):
    assert html_extract.main_text(f"<html><head><title>T</title></head><body>{body}</body></html>").split("\n") == want


def test_pii_counts_all_spans(spark):
    rows = pii.find(spark.createDataFrame([(1, "a@b.com and 10.0.0.1 there"), (2, "nothing"), (3, None)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_spans for r in rows} == {1: 2, 2: 0, 3: 0} and all(r.n_spans == len([x for x in r.spans.split(",") if x]) for r in rows)


def test_reliabilities_by_expectation_maximisation():
    """Two rounds written out vote by vote, and a labeler that is right more often gets more weight."""
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    right = [0.95, 0.8, 0.6]
    votes = np.stack([np.where(rng.random(4000) < r, np.where(truth, 1, -1), np.where(truth, -1, 1)) * (rng.random(4000) < 0.9) for r in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)

    def by_hand(rounds):
        post = [1 / (1 + np.exp(-sum(p))) for p in patterns]
        for _ in range(rounds):
            share = (sum(c * q for c, q in zip(counts, post)) + 1) / (counts.sum() + 2)
            odds = []
            for p in patterns:
                like = []
                for is_one in (True, False):
                    x = 1.0
                    for j, v in enumerate(p):
                        n = {u: 1.0 + sum(c * (q if is_one else 1 - q) for p2, c, q in zip(patterns, counts, post) if p2[j] == u) for u in (-1, 0, 1)}
                        x *= n[v] / sum(n.values())
                    like.append(x)
                odds.append(like[0] * share / (like[0] * share + like[1] * (1 - share)))
            post = odds
        return np.array(post)

    for rounds in (1, 2, 5):
        assert np.allclose(pii.estimate(patterns, counts.astype(float), rounds)[0], by_hand(rounds))
    post, share, rates = pii.estimate(patterns, counts.astype(float))
    own = {tuple(p): q for p, q in zip(patterns, post)}
    assert np.mean([(own[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.93 and abs(share - 0.3) < 0.05
    assert rates[1, 0, 2] > rates[1, 1, 2] > rates[1, 2, 2]


def test_span_classifier_finds_the_least_loss():
    """Weights on soft targets and counts are where no small change lowers the penalised loss."""
    rng = np.random.default_rng(3)
    x, target, counts = rng.integers(0, 2, (40, 4)).astype(float), rng.random(40), rng.integers(1, 50, 40).astype(float)
    w = pii.classifier(x, target, counts, steps=300)

    def loss(w):
        p = 1 / (1 + np.exp(-(np.hstack([x, np.ones((40, 1))]) @ w)))
        n = counts / counts.sum()
        return -(n * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() + 0.5e-4 * (w**2).sum()

    for i in range(5):
        for step in (-1e-2, 1e-2):
            other = w.copy()
            other[i] += step
            assert loss(other) > loss(w)
