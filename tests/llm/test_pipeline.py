"""The pipeline's stages against plain versions of their decisions."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from settleflow.llm import decontaminate, near_dedup, pii
from settleflow.llm.catalogue import QUERIES


def test_stages_run_in_order_on_what_is_left(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, small)
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids[name] = {r[0] for r in after.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        if name == "SimHash near-dedup":
            groups = near_dedup.cluster(before)
            assert ids[name] == {r[0] for r in groups.where("doc_id = component_id").select("doc_id").collect()}
        elif name == "benchmark decontamination":
            gone = {r[0] for r in decontaminate.contaminated(before, spark.read.parquet(f"{small}/benchmark.parquet")).select("doc_id").collect()}
            assert gone and ids[name] == {r[0] for r in before.select("doc_id").collect()} - gone
        elif name == "PII":
            assert all(not pii.find_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after.collect())
        before = after
    assert sorted(r[0] for r in before.select("position").collect()) == list(range(before.count()))
    final = corpus_pipeline.run(spark, small)
    assert {r[0] for r in final.select("doc_id").collect()} == ids["mixing sources to target weights"]


def test_stages_take_odd_and_empty_tables(spark, odd, nothing, small):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
            docs.count()


@pytest.mark.parametrize("n", range(1, 11))
def test_one_query_for_each_operator(n):
    assert len([q for q in QUERIES if re.match(rf"op{n}_", q)]) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_have_rows(spark, small, name):
    rows = QUERIES[name](spark, small)
    assert "doc_id" in rows.columns and rows.count() > 0 and rows.where(F.col("doc_id").isNull()).count() == 0
