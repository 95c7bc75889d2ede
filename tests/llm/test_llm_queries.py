"""The registered queries and the pipeline on the smallest tables."""

import pytest
from conftest import SF
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from tidegauge.llm import simhash
from tidegauge.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op5_decontaminate", "pipeline"}))
def test_one_row_per_document_or_piece(spark, docs, name):
    rows = QUERIES[name](spark, SF)
    assert rows.select("doc_id").distinct().count() == docs.count()


def test_pipeline_stages(spark, docs):
    at, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF).cache()
        assert dict(out.dtypes) == dict(docs.dtypes)
        assert out.join(at, "doc_id", "left_anti").count() == 0
        sizes.append(out.count())
        at = out
    assert docs.count() > sizes[0] == sizes[1] > sizes[2] > sizes[3]
    assert at.where(F.col("n_chars") != F.length("text")).count() == 0
    # Nothing is left that a second pass would call a copy.
    assert simhash.keep_one(at).count() == sizes[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert packed.select("doc_id").distinct().count() == sizes[3]
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id for r in at.collect()}


def test_pipeline_of_odd_rows(spark, odd, none):
    for rows in (odd, none):
        at = rows
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, SF)
        assert (at.count() == 0) == (rows is none)
