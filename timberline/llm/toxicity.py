"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence with telling words or word stems has
a probability that is logistic in them; sentences without any have one small
probability together, the leak, so that length alone makes no document toxic. A
document's probability is the noisy-or of these, and only document labels of a
bounded sample train it. Scoring names the sentences that carry the document's
score.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import held_out, training_sample

#: Labelled rows that the model is fitted on at most.
SAMPLE = 24_000
#: Features that enter the training, the most telling first.
FEATURES = 3_000
STEMS = (4, 5)
#: A feature's share in the log-likelihood ratio, in nats, that makes it more than chance among millions.
EVIDENCE = 16.0
#: Weight that every feature starts with; clean documents press it down where it misleads.
START = 12.0
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")
#: Share of labels that are taken to be wrong either way.
NOISE = 0.02
#: Logit of the leak at most; a sentence's logit starts from it.
FLOOR = -10.0
PENALTY = 2e-4
LIMIT = 0.5


def features(word: str) -> list[str]:
    """A word and its stems; stems end in a hyphen, which no word has."""
    return [word, *(word[:k] + "-" for k in STEMS if len(word) > k)]


def sampled(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    sample = training_sample(labels, label, bound)  # bound times two numbers: small enough to broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")


def telling(sample: DataFrame, most: int) -> list[str]:
    """The features whose presence most raises the odds of label 1.

    Counts are over different sentences, so that copies of one document count
    once; a sentence that also stands in a document of label 0 counts there.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in {f for w in set(WORD.findall(text)) for f in features(w)}:
                    counts.setdefault(f, [0, 0])[y > 0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())],
                names=["feature", "pos", "neg"],
            )

    sentences = (
        sample.select("label", F.explode(F.split(F.lower("text"), r"[.!?\n]+")).alias("sentence"))
        .where("sentence <> ''").groupBy("sentence").agg(F.min("label").alias("label"))
    )
    counted = (
        sentences.mapInArrow(run, "feature string, pos long, neg long")
        .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where("pos >= 4")
    )
    n_pos, n_neg = sample.select(F.count_if(F.col("label") > 0), F.count_if(F.col("label") <= 0)).first()
    if not n_pos or not n_neg:
        return []
    expected = (F.col("pos") + F.col("neg")) * (n_pos / (n_pos + n_neg))
    rows = (
        counted.withColumn("gain", F.col("pos") * F.log(F.col("pos") / expected))
        .where((F.col("gain") >= EVIDENCE) & (F.col("pos") > 4 * expected))
        .orderBy(F.desc("gain"), "feature").limit(most)
    )
    return [r.feature for r in rows.select("feature").collect()]


def bags(sample: DataFrame, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the sampled documents, and of all their different patterns (the telling features of a sentence that has any)
    the document, the number of features, and the features, one pattern behind the other.

    Sentences of one pattern count once in a document, so a document's share grows with
    what it says and not with how often.
    """

    def run(batches):
        import pyarrow as pa

        known: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for doc, y, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = set()
                for s in SENTENCE.findall((text or "").lower()):
                    ids: set[int] = set()
                    for w in WORD.findall(s):
                        if w not in known:
                            if len(known) > 500_000:
                                known.clear()
                            known[w] = [index[f] for f in features(w) if f in index]
                        ids.update(known[w])
                    if ids:
                        found.add(tuple(sorted(ids)))
                out.append({"doc_id": doc, "label": y, "found": sorted(found)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("found", pa.list_(pa.list_(pa.int32())))])
    rows = sample.mapInArrow(run, "doc_id long, label int, found array<array<int>>").toArrow().sort_by([("doc_id", "ascending")]).combine_chunks()
    found = rows["found"].combine_chunks()
    found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
    patterns = found.flatten()
    numbers = lambda x: x.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(found)), numbers(found.value_lengths()))
    return numbers(rows["label"].combine_chunks() if rows.num_rows else pa.array([], pa.int32())), doc, numbers(patterns.value_lengths()), numbers(patterns.flatten())


def fit(labels: np.ndarray, sent_doc: np.ndarray, sizes: np.ndarray, cols: np.ndarray, k: int, steps: int = 400) -> tuple[np.ndarray, float]:
    """Feature weights (none below 0) and bias that fit the noisy-or of the documents' patterns (see ``bags``) to the labels."""
    y = (labels > 0).astype(float)
    sent = np.repeat(np.arange(len(sizes)), sizes)
    n, m = len(y), len(sizes)
    w, b = np.full(k, START), FLOOR
    mw, vw, mb, vb = np.zeros(k), np.zeros(k), 0.0, 0.0
    for step in range(1, steps + 1):
        a = b + np.bincount(sent, weights=w[cols], minlength=m)
        a = np.clip(a, -30, 30)
        p = 1 / (1 + np.exp(-a))
        log_not = np.bincount(sent_doc, weights=-np.logaddexp(0, a), minlength=n) - np.logaddexp(0, b)
        nothing = np.exp(log_not)
        q = NOISE + (1 - 2 * NOISE) * (1 - nothing)
        # derivative of the negative log-likelihood by log_not, then by each sentence's logit
        d = -(y / q - (1 - y) / (1 - q)) * (1 - 2 * NOISE) * -nothing
        ga = d[sent_doc] * -p
        gw = np.bincount(cols, weights=ga[sent], minlength=k) / n
        gb = (ga.sum() - d.sum() / (1 + math.exp(-b))) / n
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        rate = 0.1 * (1 - step / (steps + 1))
        w -= rate * (mw / (1 - 0.9**step)) / (np.sqrt(vw / (1 - 0.999**step)) + 1e-8)
        w = np.maximum(w - rate * PENALTY * 100, 0)
        b = min(FLOOR, b - rate * (mb / (1 - 0.9**step)) / (math.sqrt(vb / (1 - 0.999**step)) + 1e-8))
        b = max(b, -14.0)
    return w, b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE) -> tuple[dict[str, float], float]:
    """Weights of features and the bias of a sentence, from at most ``bound`` labelled rows."""
    sample = sampled(docs, labels, label, bound)
    names = telling(sample, FEATURES)
    if not names:
        return {}, FLOOR
    w, b = fit(*bags(sample, {f: i for i, f in enumerate(names)}), len(names))
    return {f: float(x) for f, x in zip(names, w) if x > 1e-3}, float(b)


def scored(docs: DataFrame, model: tuple[dict[str, float], float], limit: float = LIMIT) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences of every row.

    An offending sentence has start and end (code points) and its own score; it
    is one whose probability reaches one half. Null and empty texts have no
    sentence and score 0; a null id is not held out; rows that repeat get the
    same score; an empty table gives an empty result; other columns are ignored.
    """
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # FEATURES entries at most

    def run(batches):
        import pyarrow as pa

        table, known = shared.value, {}
        leak = -math.log1p(math.exp(bias))

        def own(word: str) -> tuple:
            if word not in known:
                if len(known) > 500_000:
                    known.clear()
                known[word] = tuple((f, table[f]) for f in features(word) if f in table)
            return known[word]

        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1).to_pylist():
                low = (text or "").lower()
                text = text or ""
                hits = [w for w in set(WORD.findall(low)) if own(w)]
                total, found = leak if SENTENCE.search(low) else 0.0, []
                if hits:
                    for m in SENTENCE.finditer(text):
                        got = {f: x for w in WORD.findall(m[0].lower()) for f, x in own(w)}
                        if not got:
                            continue
                        a = bias + sum(got.values())
                        total -= math.log1p(math.exp(min(a, 30.0)))
                        if a >= 0:
                            found.append({"start": m.start(), "end": m.end(), "score": 1 / (1 + math.exp(-a))})
                scores.append(-math.expm1(total))
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                names=["doc_id", "score", "offending"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = rows.mapInArrow(run, "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")
    return out.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= limit).cast("int").alias("predicted"), "offending",
    )
