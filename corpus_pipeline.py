"""The corpus pipeline: each stage works on what its predecessor kept.

Four stages return columns of ``documents``; the last one returns pieces of
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timberline.llm import common, exact_dedup, mixing, ngram_join, packing, quality
from timberline.llm.queries import table, tokenizer_path

#: The mixed corpus has this share of the tokens that reach the stage, no document more than once.
SHARE, EPOCHS = 0.8, 1


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts.

    A null or empty text has a score like any other; a null id, nulls in other
    columns and further columns don't matter; rows that repeat go or stay together.
    """
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest doc_id.

    Null and empty texts are one group; null ids are the smallest; of rows that
    repeat an id and a text one stays.
    """
    return exact_dedup.distinct_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id.

    Texts without words are similar to none and stay; a null id goes if a row of
    its group has one; rows that share an id go or stay together.
    """
    return ngram_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents up to the budgets of their domain, language and source.

    Null languages and sources are a name of their own; texts without words cost
    nothing; ties in the seeded order, which only repeated ids have, are taken together.
    """
    return mixing.mixed(docs, SHARE, EPOCHS).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences; a null or empty text is its end id alone."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the classifier, the similarity join and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's result is written and read again, and goes when the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with common.scratch(spark) as keep:
            got = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
            keep(got)
        for path in {x.rsplit("/", 1)[0] for x in docs.inputFiles()} if name != STAGES[0][0] else ():
            common.remove(spark, path)
        docs = got
    return docs
