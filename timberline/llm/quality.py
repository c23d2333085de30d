"""Quality by a sparse ensemble of rules over text statistics.

Shallow boosted trees over statistics of a bounded, labelled sample give
conjunctive rules, one for every path from a root to a node; a logistic model
with an L1 penalty keeps few of them; what remains is compiled into one Spark
column expression, so that scoring runs inside the scan.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import held_out, training_sample

#: Labelled rows that the model is fitted on at most.
SAMPLE = 12_000
TREES = 40
DEPTH = 3
PENALTY = 0.0015
LIMIT = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text (null: empty), JVM-side; shares are per character or word."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    size = F.greatest(F.octet_length(t), F.lit(1))
    words = F.split(t, " ")
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.split(t, "\n")
    n_lines = F.greatest(F.size(lines), F.lit(1))

    def share(mark: str) -> Column:
        return (F.octet_length(t) - F.octet_length(F.replace(t, F.lit(mark)))) / size

    marks = {"bang": "!", "bar": "|", "hash": "#", "dollar": "$", "percent": "%", "ampersand": "&", "star": "*", "comma": ",", "stop": "."}
    out = {
        "log_chars": F.log1p(F.length(t)),
        "letters_word": n / n_words,
        "words_line": F.log1p(n_words / n_lines),
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "root_distinct": F.size(F.array_distinct(words)) / F.sqrt(n_words),
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "upper_runs": F.regexp_count(t, F.lit(r"\p{Lu}{2,}")) / n_words,
        "digit_runs": F.regexp_count(t, F.lit("[0-9]+")) / n_words,
    }
    out |= {name: share(mark) for name, mark in marks.items()}
    out["symbols"] = share("#") + share("$") + share("%") + share("&") + share("*") + share("!") + share("|")
    return {k: v.cast("double") for k, v in out.items()}


def grow(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], depth: int, path: tuple) -> list[tuple]:
    """Rules of one regression tree: (path, mean) of every node below the root.

    A path is a tuple of (feature, True if above, threshold).
    """
    if depth == 0 or len(rows) < 40:
        return []
    target = y[rows]
    total, best = target.sum(), (1e-9, None, None)
    for f, thresholds in enumerate(cuts):
        if not len(thresholds):
            continue
        place = np.searchsorted(thresholds, x[rows, f], side="left")
        n = np.bincount(place, minlength=len(thresholds) + 1).cumsum()[:-1]
        s = np.bincount(place, weights=target, minlength=len(thresholds) + 1).cumsum()[:-1]
        m = len(rows) - n
        ok = (n >= 15) & (m >= 15)
        if ok.any():
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1) - total**2 / len(rows), -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, float(thresholds[k]))
    if best[1] is None:
        return []
    _, f, cut = best
    below = x[rows, f] <= cut
    out = []
    for above, part in ((False, rows[below]), (True, rows[~below])):
        step = path + ((f, above, cut),)
        out += [(step, float(y[part].mean()))] + grow(x, y, part, cuts, depth - 1, step)
    return out


def holds(x: np.ndarray, path: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in path:
        out &= (x[:, f] > cut) if above else (x[:, f] <= cut)
    return out


def simplified(path: tuple) -> tuple:
    """The path with one bound per feature and side."""
    bounds: dict = {}
    for f, above, cut in path:
        k = (f, above)
        bounds[k] = cut if k not in bounds else max(bounds[k], cut) if above else min(bounds[k], cut)
    return tuple(sorted((f, above, cut) for (f, above), cut in bounds.items()))


def rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[tuple]:
    """Conjunctive rules from boosted trees on random halves of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 48))) for f in range(x.shape[1])]
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    margin = np.full(len(y), math.log(mean / (1 - mean)))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        residual = y - 1 / (1 + np.exp(-margin))
        rows = np.sort(rng.choice(len(y), max(1, (len(y) + 1) // 2), replace=False))
        tree = grow(x, residual, rows, cuts, DEPTH, ())
        parents = {p[:-1] for p, _ in tree}
        for path, mean in tree:
            found[simplified(path)] = None
            if path not in parents:
                margin[holds(x, path)] += 1.5 * mean
    return list(found)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model with an L1 penalty, by accelerated proximal steps."""
    n, k = z.shape
    rate = 4.0 / max(1e-9, float(np.linalg.norm(z, 2) ** 2) / n + 1)
    w, b, v, c, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - rate * (z.T @ g) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        b_new = c - rate * float(g.mean())
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    return w, b


def fit(x: np.ndarray, y: np.ndarray) -> tuple[list[tuple], float]:
    """Weighted rules [(path, weight)] and the intercept; a constant where labels don't differ."""
    if len(y) == 0 or y.min() == y.max():
        share = (float(y.sum()) + 1) / (len(y) + 2)
        return [], math.log(share / (1 - share))
    paths = rules(x, y)
    if not paths:
        share = float(y.mean())
        return [], math.log(share / (1 - share))
    z = np.stack([holds(x, p) for p in paths], 1).astype(np.float64)
    w, b = lasso(z, y, PENALTY)
    return [(p, float(k)) for p, k in zip(paths, w) if abs(k) > 1e-4], float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> tuple[list[str], list[tuple], float]:
    """Names of the statistics, weighted rules and intercept from at most ``bound`` labelled rows."""
    sample = training_sample(labels, label, bound)  # bound times two numbers: small enough to broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(F.broadcast(sample), "doc_id")
    # an id that repeats counts once, with the statistics of one of its texts: ``bound`` rows at most reach the driver
    joined = joined.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    stats = statistics(F.col("text"))
    got = joined.select("doc_id", "label", *[c.alias(k) for k, c in stats.items()]).toArrow().sort_by([("doc_id", "ascending")])
    x = np.stack([got.column(k).to_numpy() for k in stats], 1)
    return list(stats), *fit(x, got.column("label").to_numpy().astype(float))


def score(text: Column, model: tuple[list[str], list[tuple], float], prefix: str = "__stat_") -> tuple[list[Column], Column]:
    """Columns of the statistics that the model uses, and the score over their names."""
    names, weighted, intercept = model
    used = sorted({f for path, _ in weighted for f, _, _ in path})
    stats = statistics(text)
    columns = [stats[names[f]].alias(f"{prefix}{names[f]}") for f in used]
    margin = F.lit(intercept)
    for path, weight in weighted:
        rule = F.lit(True)
        for f, above, cut in path:
            c = F.col(f"{prefix}{names[f]}")
            rule = rule & ((c > cut) if above else (c <= cut))
        margin = margin + F.when(rule, F.lit(weight)).otherwise(F.lit(0.0))
    return columns, 1 / (1 + F.exp(-margin))


def accepted(docs: DataFrame, model: tuple, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` whose score reaches the limit, with all their columns."""
    own, prefix = docs.columns, free_prefix(docs)
    columns, value = score(F.col("text"), model, prefix)
    # the row number keeps the filter above the projection, which else would compute every statistic for every rule
    rows = docs.select("*", *columns, F.monotonically_increasing_id().alias(f"{prefix}row"))
    return rows.where((value >= limit) & (F.col(f"{prefix}row") >= 0)).select(*own)


def free_prefix(docs: DataFrame) -> str:
    """A prefix that no column of ``docs`` begins with."""
    prefix = "__stat_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return prefix


def scored(docs: DataFrame, model: tuple, limit: float = LIMIT) -> DataFrame:
    """Every row with held_out, score and predicted; other columns are kept as they are.

    A null text counts as empty and gets a score; a null id is not held out;
    rows that repeat get the same score; an empty table gives an empty result.
    Columns of the input named held_out, score or predicted are replaced.
    """
    own = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    columns, value = score(F.col("text"), model, free_prefix(docs))
    return (
        docs.select(*own, *columns)
        .select(*own, F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), value.alias("score"))
        .withColumn("predicted", (F.col("score") >= limit).cast("int"))
    )
