import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from timberline.llm import queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    if name in queries.ORACLES:
        want = duck.sql(queries.ORACLES[name])
        assert sorted(want.columns) == columns
        assert got == sorted(map(repr, want.select(", ".join(columns)).fetchall()))
    else:
        rows = duck.sql(f"SELECT count(*) FROM {'pages' if 'op10' in name else 'documents'}").fetchall()[0][0]
        assert len(got) >= rows


def test_pipeline_stages(spark, sf_dir):
    """Every stage works on all that its predecessor kept, and the result is that of the stages by hand."""
    docs = queries.table(spark, sf_dir, "documents")
    columns, seen = docs.columns, [docs.count()]
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.common.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        seen.append(docs.count())
        texts[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0 and seen[0] > seen[-1]
    lower = [x.lower() for x in texts["exact_dedup"].values() if x.isascii()]
    assert len(lower) == len(set(lower))
    assert set(texts["near_dedup"]) <= set(texts["exact_dedup"]) <= set(texts["quality"])
    packed = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert packed == set(texts["mixing"])


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.written(stage(spark, docs, sf_dir), "none")
        assert docs.count() == 0


def test_pipeline_on_awkward_rows(spark, sf_dir, tmp_path):
    """Nulls, empty and long texts, repeats, and columns with names that the operators use go through all stages."""
    from tests.llm.test_llm_operators import CLASH, DOCS, awkward_rows

    rows = spark.createDataFrame(awkward_rows(), DOCS)
    for c in CLASH:
        rows = rows.withColumn(c, F.lit("clash"))
    docs = corpus_pipeline.common.written(rows, "awkward")
    columns, ids = docs.columns, {r[0] for r in awkward_rows()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.written(stage(spark, docs, sf_dir), name)
        got = docs.collect()
        assert {r.doc_id for r in got} <= ids
        if name != "packing":
            assert docs.columns == columns and all(r.score == "clash" and r["__stat_log_chars"] == "clash" for r in got)
