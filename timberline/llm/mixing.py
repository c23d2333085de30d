"""Mixing sources to target weights by hierarchical budgeting.

Sources are leaves of a tree of domains, languages and sources. A budget of
tokens goes down the tree by weight; what a node can't use, because all its
documents in all allowed epochs are fewer, goes to its siblings first and to
its ancestors' siblings only where they are exhausted too. Every leaf takes its
whole epochs and then a prefix, by tokens, of the next epoch's seeded order.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timberline.llm.common import small_side, written



@dataclass(frozen=True)
class Tree:
    """The tree of domains, languages and sources, its integer weights (a name that is missing weighs 1), and the order's seed.

    ``domain`` is SQL, of Spark and DuckDB alike, over a source's name in column ``source``.
    """

    domain: str = "source"
    domain_weights: Mapping[str, int] = field(default_factory=dict)
    lang_weights: Mapping[str, int] = field(default_factory=dict)
    source_weights: Mapping[str, int] = field(default_factory=dict)
    seed: int = 20

    def domain_of(self, source: str) -> str:
        return re.sub(r"\bsource\b", lambda m: source, self.domain)

    def key(self, epoch: str) -> str:
        return f"md5(concat_ws(':', '{self.seed}', cast({epoch} AS string), coalesce(cast(doc_id AS string), '')))"


#: The tree of the driver's documents.
DEFAULT = Tree(
    "CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) <= 4 THEN 'reference' ELSE 'forum' END",
    {"crawl": 40, "reference": 35, "forum": 25}, {"en": 50, "de": 20, "fr": 20, "es": 10},
)
#: Rows of a leaf in one range of the order's key, on average, at most; ranges are the key's leading hex digits.
RANGE_ROWS = 50_000
TOKENS = r"regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def case(column: str, weights: Mapping[str, int]) -> str:
    if not weights:
        return "1"
    whens = " ".join("WHEN '" + k.replace("'", "''") + f"' THEN {int(v)}" for k, v in weights.items())
    return f"CASE {column} {whens} ELSE 1 END"


def shared_out(nodes: DataFrame, parents: list[str], budget: str, order: list[str]) -> DataFrame:
    """Adds granted: each node's share of its parent's ``budget`` by weight, none above its capacity.

    With the nodes of a parent in order of capacity per weight, the level to
    which the others fill up is the largest of the levels that follow from
    exhausting the first ones.
    """
    of = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    ranked = of.orderBy(F.col("capacity") / F.col("weight"), *order)
    before = F.coalesce(F.sum("capacity").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = nodes.withColumn("_level", (F.col(budget) - before).cast("double") / rest.cast("double"))
    leveled = leveled.withColumn("_level", F.greatest(F.max("_level").over(of), F.lit(0.0)))
    return leveled.withColumn("granted", F.least("capacity", F.floor(F.col("weight") * F.col("_level")).cast("long"))).drop("_level")


def leaves(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, domain, lang, source and tokens of every row; null names become empty."""
    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "coalesce(cast(lang AS string), '') AS lang", "coalesce(cast(source AS string), '') AS source", f"cast({TOKENS} AS bigint) AS n_tokens")
    return rows.selectExpr("doc_id", f"{tree.domain} AS domain", "lang", "source", "n_tokens")


def budgets(slim: DataFrame, share: float, epochs: int, tree: Tree) -> DataFrame:
    """domain, lang, source, tokens, rows and granted of every leaf; the budget is a share of all tokens."""
    names = ["domain", "lang", "source"]
    leaf = slim.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")).withColumn("capacity", F.col("tokens") * epochs)
    everything = Window.partitionBy(F.lit(1))

    def level(keys: list[str], weight: str) -> DataFrame:
        return leaf.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"), F.sum("n_rows").alias("n_rows")).withColumn("weight", F.expr(weight))

    top = level(["domain"], case("domain", tree.domain_weights)).withColumn("budget", F.floor(F.sum("tokens").over(everything) * F.lit(share)).cast("long"))
    top = shared_out(top, [], "budget", ["domain"]).select("domain", F.col("granted").alias("budget"))
    mid = shared_out(level(["domain", "lang"], case("lang", tree.lang_weights)).join(top, "domain"), ["domain"], "budget", ["lang"])
    mid = mid.select("domain", "lang", F.col("granted").alias("budget"))
    low = level(names, case("source", tree.source_weights)).join(mid, ["domain", "lang"])
    return shared_out(low, ["domain", "lang"], "budget", ["source"]).select(*names, "tokens", "n_rows", "granted")


def cuts(slim: DataFrame, granted: DataFrame, tree: Tree) -> DataFrame:
    """domain, lang, source, whole (epochs taken in full) and cut (the last key of the next epoch that is taken).

    Running sums of a leaf are taken within ranges of the key and over the
    ranges' totals, so that no task holds a leaf; there are as many ranges as the
    largest leaf needs. Rows with one key, those that
    repeat an id, are taken together or not at all.
    """
    names = ["domain", "lang", "source"]
    plan = granted.selectExpr(*names, "n_rows", "CASE WHEN tokens > 0 THEN granted div tokens ELSE 0 END AS whole", "CASE WHEN tokens > 0 THEN granted % tokens ELSE 0 END AS rest")
    plan = small_side(plan, "mix-plan")
    largest = plan.agg(F.max("n_rows")).first()[0] or 1
    digits = max(3, math.ceil(math.log(max(1, largest / RANGE_ROWS), 16)))
    keyed = slim.join(plan.drop("n_rows"), names).withColumn("key", F.expr(tree.key("whole"))).withColumn("part", F.substring("key", 1, digits))
    totals = keyed.groupBy(*names, "part").agg(F.sum("n_tokens").alias("part_tokens"))
    over = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*names, "part", F.coalesce(F.sum("part_tokens").over(over), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*names, "part").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = keyed.withColumn("inside", F.sum("n_tokens").over(inside)).join(offsets, [*names, "part"])
    last = run.where(F.col("offset") + F.col("inside") <= F.col("rest")).groupBy(*names).agg(F.max("key").alias("cut"))
    return plan.select(*names, "whole").join(last, names, "left")


def mixed(docs: DataFrame, share: float = 1.0, epochs: int = 2, tree: Tree = DEFAULT) -> DataFrame:
    """The taken rows of ``docs`` with all their columns and __mix_domain, __mix_epoch and __mix_tokens.

    The budget is ``share`` of all tokens (words between white space); no row is
    taken more than ``epochs`` times. Null languages and sources are a name of
    their own, the empty one; null and empty texts have no tokens and cost
    nothing, and a leaf of such alone is taken once; a null id has a place in the order like any other; rows that repeat
    an id are taken together. An empty table gives an empty result. Columns of the
    input with the names of the added ones are replaced, all others stay.
    """
    own = [c for c in docs.columns if c.lower() not in ("__mix_domain", "__mix_epoch", "__mix_tokens")]
    slim = written(leaves(docs, tree), "mix")
    names = ["domain", "lang", "source"]
    free = "__mix_"
    while any(c.lower().startswith(free) for c in own):
        free = "_" + free
    cut = cuts(slim, budgets(slim, share, epochs, tree), tree).select(*(F.col(c).alias(f"{free}m_{c}") for c in names), F.col("whole").alias(f"{free}m_whole"), F.col("cut").alias(f"{free}m_cut"))
    rows = docs.select(*own).selectExpr("*", f"coalesce(cast(lang AS string), '') AS {free}l", f"coalesce(cast(source AS string), '') AS {free}s", f"cast({TOKENS} AS bigint) AS {free}n")
    rows = rows.withColumn(f"{free}d", F.expr(tree.domain_of(f"{free}s")))
    cut = small_side(cut, "mix-cuts")
    joined = rows.join(cut, (rows[f"{free}d"] == cut[f"{free}m_domain"]) & (rows[f"{free}l"] == cut[f"{free}m_lang"]) & (rows[f"{free}s"] == cut[f"{free}m_source"]))
    times = F.expr(f"{free}m_whole + IF({free}m_cut IS NOT NULL AND {tree.key(free + 'm_whole')} <= {free}m_cut, 1, 0)").cast("int")
    return (
        joined.withColumn(f"{free}times", times).where(f"{free}times > 0")
        .withColumn(f"{free}e", F.explode(F.sequence(F.lit(0), F.col(f"{free}times") - 1)))
        .select(*own, F.col(f"{free}d").alias("__mix_domain"), F.col(f"{free}e").alias("__mix_epoch"), F.col(f"{free}n").alias("__mix_tokens"))
    )


def mix(docs: DataFrame, share: float = 1.0, epochs: int = 2, tree: Tree = DEFAULT) -> DataFrame:
    """doc_id, domain, lang, source, epoch and n_tokens of every taken row."""
    out = mixed(docs.select("doc_id", "lang", "source", "text"), share, epochs, tree)
    return out.select("doc_id", F.col("__mix_domain").alias("domain"), "lang", "source", F.col("__mix_epoch").alias("epoch"), F.col("__mix_tokens").alias("n_tokens"))


def oracle(share: float = 1.0, epochs: int = 2, source: str = "documents", tree: Tree = DEFAULT) -> str:
    """The same rows in DuckDB's SQL."""

    def level(name: str, parents: str, rows: str, order: str) -> str:
        by = f"PARTITION BY {parents} " if parents else ""
        keep = f"{parents}, {order}" if parents else order
        return (
            f"{name}_l AS (SELECT *, (budget - coalesce(sum(capacity) OVER ({by}ORDER BY capacity / weight, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE"
            f" / (sum(weight) OVER ({by}ORDER BY capacity / weight, {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lv FROM {rows}),\n"
            f"{name} AS (SELECT {keep}, tokens, least(capacity, floor(weight * greatest(max(lv) OVER ({f'PARTITION BY {parents}' if parents else ''}), 0.0))::BIGINT) AS granted FROM {name}_l)"
        )

    key = f"md5(concat_ws(':', '{tree.seed}', whole::VARCHAR, coalesce(doc_id::VARCHAR, '')))"
    return f"""
WITH slim AS (
  SELECT doc_id, lang, source, {tree.domain_of("coalesce(source, '')")} AS domain, coalesce(lang, '') AS l, coalesce(source, '') AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM {source}),
leaf AS (SELECT domain, l, s, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {epochs})::BIGINT AS capacity FROM slim GROUP BY ALL),
d AS (SELECT domain, sum(tokens)::BIGINT AS tokens, sum(capacity)::BIGINT AS capacity, {case('domain', tree.domain_weights)} AS weight FROM leaf GROUP BY domain),
d_b AS (SELECT *, floor(sum(tokens) OVER () * {share!r}::DOUBLE)::BIGINT AS budget FROM d),
{level('dg', '', 'd_b', 'domain')},
m_b AS (SELECT x.*, dg.granted AS budget FROM (SELECT domain, l, sum(tokens)::BIGINT AS tokens, sum(capacity)::BIGINT AS capacity, {case('l', tree.lang_weights)} AS weight FROM leaf GROUP BY domain, l) x JOIN dg USING (domain)),
{level('mg', 'domain', 'm_b', 'l')},
s_b AS (SELECT leaf.*, {case('s', tree.source_weights)} AS weight, mg.granted AS budget FROM leaf JOIN mg USING (domain, l)),
{level('sg', 'domain, l', 's_b', 's')},
plan AS (SELECT domain, l, s, CASE WHEN tokens > 0 THEN granted // tokens ELSE 0 END AS whole, CASE WHEN tokens > 0 THEN granted % tokens ELSE 0 END AS rest FROM sg),
keyed AS (SELECT slim.*, whole, rest, {key} AS k FROM slim JOIN plan USING (domain, l, s)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, l, s ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed),
timed AS (SELECT *, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS times FROM run)
SELECT doc_id, domain, lang, source, unnest(range(times))::INTEGER AS epoch, n_tokens FROM timed WHERE times > 0
"""
