"""Personal data by weak supervision, JVM-side throughout.

Fixed patterns give base spans, which always stay, and wider ones give
candidates. Regex, gazetteer and context labelers vote on every candidate of the
whole corpus; the gazetteers list top-level domains, card issuers' and country
calling codes, account countries and given names, and are parameters; only counts of vote and feature patterns, a few hundred rows
at most, reach the driver, where expectation-maximisation estimates the
labelers' reliabilities and a logistic span classifier is trained on the
posteriors. The classifier is compiled into a column expression.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.common import written

# The contract's patterns, written so that the engine never tries a run twice: a match starts at the end of the last
# one or where no character of its first class precedes, and classes that exclude what follows don't give back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: Whether a match counts, as SQL over its ``value``.
VALID = {
    "email": "true",
    "ip": rf"value rlike '^{PART}(?:\\.{PART}){{3}}$'",
    "card": "length(regexp_replace(value, '[^0-9]', '')) between 13 and 19 and luhn_check(regexp_replace(value, '[^0-9]', ''))",
    "phone": "length(regexp_replace(value, '[^0-9]', '')) between 9 and 15",
}
#: What a text has to hold before its patterns are looked for.
NEEDS = {
    "email": "contains(_t, '@')",
    "ip": r"_t rlike '[0-9]\\.[0-9]++\\.[0-9]'",
    "card": r"_t rlike '[0-9](?:[ -]?[0-9]){12}'",
    "phone": "contains(_t, '+')",
    "names": r"_t rlike '\\p{Lu}\\p{Ll}++ \\p{Lu}\\p{Ll}'",
    "more": r"_t rlike 'AKIA|[0-9]{3}-[0-9]{2}-[0-9]|[0-9][0-9A-Za-z]{11}'",
}
MORE = (
    r"AKIA[0-9A-Z]{16}"
    r"|(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
    r"|(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+"
    r"|(?<![0-9A-Za-z])[A-Za-z]{0,12}[0-9][0-9A-Za-z]{11,}+"
)
#: Two or three capitalised words; they are a candidate if the first one is a listed name.
NAMES = r"(?<![\p{L}0-9_'-])\p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++){1,2}+(?![\p{L}0-9_])"
KINDS = [*BASE, "secret", "ssn", "iban", "number", "name"]

# Lists in which the parts of a span that identify it are looked up.
GAZETTEERS = {
    "domains": (
        "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "dev", "app", "at", "au", "be", "br", "ca", "ch", "cn", "cz", "de", "dk", "es",
        "eu", "fi", "fr", "gr", "hu", "ie", "in", "it", "jp", "kr", "mx", "nl", "no", "nz", "pl", "pt", "ro", "ru", "se", "sg", "tr", "uk", "us", "za",
    ),
    "issuers": ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65"),
    "calling": ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "64", "65", "81", "82", "86", "90", "91"),
    "countries": ("AD", "AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV", "MC", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK", "SM", "TR"),
    "names": (
        "Alexander", "Alice", "Amelia", "Andrea", "Anna", "Anne", "Antonio", "Barbara", "Carlos", "Carmen", "Charles", "Charlotte", "Christian", "Claire", "Daniel", "David", "Elena", "Elizabeth",
        "Emily", "Emma", "Felix", "Francisco", "George", "Hannah", "Hans", "Helen", "Henry", "Isabel", "Jack", "James", "Jean", "Jennifer", "Johann", "John", "Jonas", "Jorge", "Joseph", "Juan",
        "Julia", "Julien", "Karl", "Katharina", "Laura", "Linda", "Louis", "Lucas", "Lucie", "Manuel", "Marco", "Maria", "Marie", "Martin", "Mary", "Michael", "Miguel", "Monika", "Nicolas",
        "Olivia", "Patricia", "Paul", "Pedro", "Peter", "Petra", "Philip", "Pierre", "Richard", "Robert", "Sarah", "Sofia", "Sophie", "Stefan", "Susan", "Thomas", "Ursula", "William", "Wolfgang",
    ),
}
CUES = ("password", "passwd", "pwd", "secret", "token", "key", "ssn", "iban", "account", "mail", "phone", "tel", "card", "ip", "license")
#: Labelers: 1 for personal, -1 against, 0 abstains.
LABELERS = {
    "shape": r"CASE WHEN base OR value rlike '^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,}|[0-8][0-9]{2}-[0-9]{2}-[0-9]{4})$' THEN 1 ELSE 0 END",
    "cue": rf"CASE WHEN lower(before) rlike '(?:{'|'.join(CUES)})[^a-z0-9]*$' THEN 1 ELSE 0 END",
    "assigned": r"CASE WHEN before rlike '[=:][ ]?[\"\']?$' THEN 1 ELSE 0 END",
    "mixed": r"CASE WHEN NOT base AND value rlike '[0-9]' AND value rlike '[A-Za-z]' AND length(value) >= 16 THEN 1 WHEN NOT base AND NOT value rlike '[A-Za-z]' THEN -1 ELSE 0 END",
    "varied": "CASE WHEN NOT base AND size(array_distinct(split(value, ''))) <= 4 THEN -1 ELSE 0 END",
    "listed": "CASE WHEN kind = 'ip' OR kind IN ('secret', 'ssn', 'number') THEN 0 WHEN listed THEN 1 ELSE -1 END",
    "bounded": r"CASE WHEN before rlike '[0-9A-Za-z]$' OR after rlike '^[0-9A-Za-z]' THEN -1 ELSE 0 END",
}
#: Inputs of the span classifier besides its kind, as SQL that gives 0 or 1.
FEATURES = {
    "base": "int(base)",
    "listed": "int(listed)",
    "long": "int(length(value) >= 32)",
    "digits": "int(length(regexp_replace(value, '[^0-9]', '')) * 2 >= length(value))",
    "upper": "int(NOT value rlike '[a-z]')",
    "quoted": r"int(before rlike '[\"\']$')",
    "equals": r"int(before rlike '[=:][ ]?[\"\']?$')",
    "inside": r"int(before rlike '[0-9A-Za-z]$' OR after rlike '^[0-9A-Za-z]')",
}
LIMIT = 0.5
BLOCK = 64


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Adds for every pattern an array of its matches in _t: start (code points), value, before and after.

    Matches and the pieces between them come from the same engine; starts are
    sums of lengths, taken over blocks, so that many matches in one text stay cheap.
    """
    names = list(patterns)
    df = df.selectExpr("*", *(f"CASE WHEN {NEEDS[k]} THEN regexp_extract_all(_t, {quoted(p)}, 0) ELSE array() END AS _m_{k}" for k, p in patterns.items()))
    df = df.selectExpr("*", *(f"CASE WHEN size(_m_{k}) > 0 THEN split(_t, {quoted(p)}, -1) ELSE array() END AS _p_{k}" for k, p in patterns.items()))
    df = df.selectExpr("*", *(f"zip_with(slice(_p_{k}, 1, size(_m_{k})), _m_{k}, (a, b) -> length(a) + length(b)) AS _l_{k}" for k in names))
    total = "aggregate({}, 0, (x, y) -> x + y)".format
    df = df.selectExpr("*", *(f"transform(sequence(0, size(_l_{k}) div {BLOCK}), b -> {total(f'slice(_l_{k}, int(b) * {BLOCK} + 1, {BLOCK})')}) AS _s_{k}" for k in names))
    found = (
        f"transform(_m_{{k}}, (v, i) -> named_struct('start', {total(f'slice(_s_{{k}}, 1, int(i div {BLOCK}))')}"
        f" + {total(f'slice(_l_{{k}}, int(i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK})')} + length(_p_{{k}}[i]),"
        " 'value', v, 'before', right(_p_{k}[i], 24), 'after', left(_p_{k}[i + 1], 4))) AS _f_{k}"
    )
    own = [c for c in df.columns if not c.startswith(("_m_", "_p_", "_l_", "_s_"))]
    return df.selectExpr(*own, *(found.format(k=k) for k in names))


def lookup(gazetteers: dict[str, tuple[str, ...]]) -> str:
    """SQL that tells whether the identifying part of a span x is listed: its value's domain, issuer, calling code, country or first name."""

    def among(part: str, name: str) -> str:
        return f"array_contains(array({', '.join(map(quoted, gazetteers[name])) or quoted('')}), {part})"

    digits = "regexp_replace(x.value, '[^0-9]', '')"
    starts = lambda name: "(" + " OR ".join(among(f"left({digits}, {n})", name) for n in (1, 2, 3)) + ")"
    return (
        f"CASE x.kind WHEN 'email' THEN {among(chr(39).join(('lower(regexp_extract(x.value, ', '[^.]+$', ', 0))')), 'domains')} WHEN 'card' THEN {starts('issuers')}"
        f" WHEN 'phone' THEN {starts('calling')} WHEN 'iban' THEN {among('left(x.value, 2)', 'countries')} WHEN 'name' THEN {among(chr(39).join(('split_part(x.value, ', ' ', ', 1)')), 'names')} ELSE false END"
    )


def candidates(docs: DataFrame, gazetteers: dict[str, tuple[str, ...]] = GAZETTEERS) -> DataFrame:
    """doc_id and the valid base spans and further candidates of every row, in the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    rows = spans(rows, BASE | {"more": MORE, "names": NAMES})
    names = f"array({', '.join(map(quoted, gazetteers['names'])) or quoted('')})"

    def valid(kind: str) -> str:
        test = VALID[kind].replace("value", "x.value")
        return f"transform(filter(_f_{kind}, x -> {test}), x -> named_struct('kind', '{kind}', 'start', x.start, 'end', x.start + length(x.value), 'value', x.value, 'before', x.before, 'after', x.after, 'base', true))"

    kind = (
        "CASE WHEN x.value rlike '^AKIA[0-9A-Z]{16}$' THEN 'secret' WHEN x.value rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' THEN 'ssn'"
        " WHEN x.value rlike '^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$' THEN 'iban' WHEN x.value rlike '^[0-9]+$' THEN 'number' ELSE 'secret' END"
    )
    rows = rows.selectExpr("doc_id", "_f_more", "_f_names", "concat(" + ", ".join(valid(k) for k in BASE) + ") AS base_spans")
    more = f"transform(_f_more, x -> named_struct('kind', {kind}, 'start', x.start, 'end', x.start + length(x.value), 'value', x.value, 'before', x.before, 'after', x.after, 'base', false))"
    named = f"transform(filter(_f_names, x -> array_contains({names}, split_part(x.value, ' ', 1))), x -> named_struct('kind', 'name', 'start', x.start, 'end', x.start + length(x.value), 'value', x.value, 'before', x.before, 'after', x.after, 'base', false))"
    looked = f"x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'value', x.value, 'before', x.before, 'after', x.after, 'base', x.base, 'listed', {lookup(gazetteers)})"
    apart = "x -> NOT exists(base_spans, b -> b.start < x.end AND x.start < b.end)"
    rows = rows.selectExpr("doc_id", f"transform(base_spans, {looked}) AS base_spans", f"transform(filter(concat({more}, {named}), {apart}), {looked}) AS more_spans")
    return written(rows, "pii")


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float, np.ndarray]:
    """Posteriors of the vote patterns, the share of personal spans, and each labeler's vote probabilities by class.

    The labelers are taken to be independent given the class; the start is the
    majority vote, and every probability is smoothed.
    """
    values = (-1, 0, 1)
    post = 1 / (1 + np.exp(-votes.sum(1).astype(float)))
    share, rates = 0.5, np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        mass = counts * post
        share = float((mass.sum() + 1) / (counts.sum() + 2))
        for c, weight in ((1, mass), (0, counts - mass)):
            for j in range(votes.shape[1]):
                n = np.array([weight[votes[:, j] == v].sum() for v in values]) + 1.0
                rates[c, j] = n / n.sum()
        logs = [np.log(rates[c])[np.arange(votes.shape[1]), votes + 1].sum(1) for c in (0, 1)]
        post = 1 / (1 + np.exp(np.clip(logs[0] + math.log(1 - share) - logs[1] - math.log(share), -50, 50)))
    return post, share, rates


def classifier(x: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic model (the last one is the intercept) on soft targets, by Newton's method."""
    z = np.hstack([x, np.ones((len(x), 1))])
    n = counts / counts.sum()
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (n * (p - target)) + ridge * 1e-2 * w
        h = (z * (n * p * (1 - p))[:, None]).T @ z + ridge * np.eye(z.shape[1])
        w -= np.linalg.solve(h, g)
    return w


def train(found: DataFrame) -> str:
    """SQL of a span's probability, over kind, value, before, after and base, from the votes on all candidates."""
    flat = found.selectExpr("explode(concat(base_spans, more_spans)) AS s").select("s.*")
    keys = [*LABELERS, "kind", *(f"f_{k}" for k in FEATURES)]
    table = (
        flat.selectExpr("kind", *(f"{e} AS {k}" for k, e in LABELERS.items()), *(f"{e} AS f_{k}" for k, e in FEATURES.items()))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys).collect()
    )
    if not table:
        return "0.0D"
    counts = np.array([r.n for r in table], float)
    votes = np.array([[r[k] for k in LABELERS] for r in table], int)
    post, _, _ = estimate(votes, counts)
    x = np.array([[*(float(r.kind == k) for k in KINDS), *(float(r[f"f_{k}"]) for k in FEATURES)] for r in table])
    w = classifier(x, post, counts).tolist()
    terms = [f"IF(kind = '{k}', {v!r}D, 0D)" for k, v in zip(KINDS, w)]
    terms += [f"{v!r}D * ({e})" for v, e in zip(w[len(KINDS) :], FEATURES.values())]
    return f"1 / (1 + exp(-({w[-1]!r}D + {' + '.join(terms)})))"


def find(docs: DataFrame, limit: float = LIMIT, gazetteers: dict[str, tuple[str, ...]] = GAZETTEERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of base spans, base_sha256, spans and n_spans, the number of all of them.

    A span is kind:start:end in code points, end exclusive; kinds stand in the
    order of ``KINDS``, then starts. Candidates that overlap a base span never
    come up. A null or empty text has no spans; a null id stays null; rows that
    repeat give equal rows; an empty table gives an empty result; other columns
    are ignored.
    """
    found = candidates(docs, gazetteers)
    p = train(found)
    for name in ("kind", "value", "before", "after", "base", "listed"):
        p = _qualified(p, name)
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    text = "concat_ws(',', transform(array_sort(transform({}, x -> named_struct('k', " + order + ", 's', x.start, 't', concat(x.kind, ':', x.start, ':', x.end)))), y -> y.t))"
    rows = found.selectExpr("doc_id", "base_spans", f"concat(base_spans, filter(more_spans, x -> {p} >= {limit!r})) AS all_spans")
    return rows.selectExpr(
        "doc_id",
        *(f"cast(size(filter(base_spans, x -> x.kind = '{k}')) AS bigint) AS n_{k}" for k in BASE),
        f"sha2({text.format('base_spans')}, 256) AS base_sha256",
        f"{text.format('all_spans')} AS spans",
        "cast(size(all_spans) AS bigint) AS n_spans",
    )


def _qualified(sql: str, name: str) -> str:
    import re

    return re.sub(rf"(?<![.\w'\"]){name}(?![\w'(])", f"x.{name}", sql)
