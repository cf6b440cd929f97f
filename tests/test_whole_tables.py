"""Queries that take every document and every text whole."""

import json

from quarry.operators import chunking as ch
from quarry.plans import catalog  # noqa: F401  (registers every query)
from quarry.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_document_is_reranked(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id for r in ch.hierarchical_chunks(docs, "text", ["doc_id"], sep="\n").collect()}
    for name in ("rerank", "rerank_all", "rerank_top3"):
        got = {r.doc_id for r in QUERIES[name](spark, SF).collect()}
        assert got == docs and len(docs) > 100


def test_whole_texts_as_json(spark, tmp_path):
    texts = ["x" * 70 + '"quoted" \\ \n\r\t\x01 \U0001f600 \u00e9', "", None, "y" * 60, "y" * 61]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    for name in ("metadata_json", "metadata_json_whole"):
        got = {r.doc_id: json.loads(r.metadata) for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert [got[i].get("text") for i in range(5)] == texts
