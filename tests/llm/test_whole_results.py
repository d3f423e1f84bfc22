"""Queries and stages return all they are to return."""

import numpy as np

import corpus_pipeline
from quantloom.llm import queries


def test_op1_returns_ids_and_texts(spark, tmp_path):
    spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op1_sentencepiece(spark, str(tmp_path)).collect()}
    assert got[1].decoded == "two words" and got[2].decoded == ""
    assert all(len(np.frombuffer(r.ids, "<u4")) == r.n_ids for r in got.values()) and got[1].n_ids > 0


def test_documents_stay_where_none_has_a_label(spark):
    docs = spark.createDataFrame([(1, "clean text", None), (2, "漢字", None), (3, "12 !", None), (4, None, None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.identify(spark, docs, "").collect()) == [1, 2]
