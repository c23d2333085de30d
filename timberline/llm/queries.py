"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import timberline
from timberline.llm import exact_dedup, mixing


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    timberline.importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import ngram_join

    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op2_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import quality

    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text"), model).drop("text")


def op3_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op4_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import pii

    return pii.find(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import flac

    return flac.stored_and_read(table(spark, sf_dir, "documents"))


def op10_tag_path_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import html_extract

    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_token_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import common, rans

    path = common.shared_dir(spark, "rans")
    rans.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_path())
    rows = common.written(rans.read_ids(spark, path, with_ids=False), "rans-rows")
    return rans.starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import simhash

    return simhash.fingerprinted(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import periodic_runs

    return periodic_runs.find(table(spark, sf_dir, "documents"), periodic_runs.with_repetition)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from timberline.llm import spelling

    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_rule_ensemble_quality": op2_rule_ensemble_quality,
    "op3_streaming_exact_dedup": op3_streaming_exact_dedup,
    "op4_noisy_or_toxicity": op4_noisy_or_toxicity,
    "op8_flac_media": op8_flac_media,
    "op10_tag_path_ratio": op10_tag_path_ratio,
    "op5_hierarchical_mixing": op5_hierarchical_mixing,
    "op6_weak_supervision_pii": op6_weak_supervision_pii,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op9_token_rans": op9_token_rans,
    "op11_simhash_fingerprints": op11_simhash_fingerprints,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op5_hierarchical_mixing": mixing.oracle(),
    "op3_streaming_exact_dedup": exact_dedup.ORACLE,
}
