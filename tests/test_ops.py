"""Numbering under skew, expansion, rerank, metrics, registry."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import embedding as emb
from quarry.operators import expansion, metrics, rerank
from quarry.operators.numbering import number_within


def test_numbering_with_a_hot_group(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"g{i % 50}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, x long").repartition(5)
    out = number_within(df, ["g"], [F.col("x")], out="rn", num_partitions=8).toPandas()
    out = out.sort_values(["g", "x"])
    assert (out.groupby("g").cumcount().to_numpy() + 1 == out["rn"].to_numpy()).all()


def test_expansion(spark):
    syn = spark.createDataFrame(
        [("car", s, l, f"lem_{s}_{l}") for s in range(1, 7) for l in range(1, 7)]
        + [("fast", 1, 1, "quick")], "token string, synset_rank int, lemma_rank int, lemma string")
    q = spark.createDataFrame([(1, "Car fast car"), (2, "nothing"), (3, None)], "id int, text string")
    got = {r.id: r.expanded for r in expansion.expand_queries(q, "id", "text", syn).collect()}
    terms = got[1][len("Car fast car "):].split(" ")
    assert "quick" in terms and "lem" in terms and "6" not in terms
    assert got[2] == "nothing "      # no terms: a trailing space
    assert got[3] is None


def test_rerank_stable_ties(spark):
    df = spark.createDataFrame([(1, 0, "a b", "a"), (1, 1, "a b", "b"), (1, 2, "a b", "a b"),
                                (2, 0, "", "x")], "doc int, chunk_index int, q string, c string")
    out = rerank.rerank(df, "doc", F.col("q"), F.col("c")).orderBy("doc", "rerank_pos").collect()
    assert [(r.chunk_index, r.rerank_pos) for r in out] == [(2, 1), (0, 2), (1, 3)]  # doc 2: no query


def test_histogram_and_gauge(spark):
    log = spark.createDataFrame([("a", 0.005, 1, True), ("a", 0.3, 2, True), ("a", 100.0, 3, True),
                                 ("a", 0.02, 4, False)], "op string, v double, ts int, ok boolean")
    h = {r.le: r.n for r in metrics.duration_histogram(log, F.col("v"), ["op"], F.col("ok")).collect()}
    assert h["0.01"] == 1 and h["0.5"] == 2 and h["60.0"] == 2 and h["+Inf"] == 3
    g = metrics.last_value(log, F.col("v"), F.col("ts"), ["op"]).first()
    assert g.last_value == 0.02


def test_run_log(spark):
    log = metrics.RunLog()
    f = log.wrap("save")(lambda n: list(range(n)))
    f(3)
    with pytest.raises(ZeroDivisionError):
        log.record("bad", lambda: 1 / 0)
    rows = log.frame(spark).collect()
    assert [(r.op, r.n_rows, r.ok) for r in rows] == [("save", 3, True), ("bad", None, False)]


def test_registry(spark):
    req = spark.createDataFrame([(1, "sentence-transformers/all-mpnet-base-v2"), (2, "nope"), (3, None)],
                                "id int, model string")
    out = {r.id: (r.model, r.dim, r.status) for r in
           emb.resolve_models(req, emb.registry_frame(spark), emb.MODEL_REGISTRY[0][1]).collect()}
    assert out[1][1:] == (768, "ok") and out[2][2] == "rejected" and out[3][1] == 1024


def test_hash_embedding_unit_and_model_hook(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id int, t string")
    got = {r.id: r for r in emb.embed(df, "t", 8).collect()}
    assert sum(x * x for x in got[1].embedding) == pytest.approx(1.0, rel=1e-6)
    assert got[2].embedding == [0.0] * 8

    def load():
        def enc(texts):
            if "boom" in texts:
                raise RuntimeError
            return [[float(len(t))] * 3 for t in texts]
        return enc
    df2 = spark.createDataFrame([("ab",), ("boom",)], "t string").coalesce(1)
    out = emb.embed(df2, "t", 4, emb.model_embedder(load, 4), ).collect()
    assert [(r.embed_failed, r.embedding) for r in out] == [
        (False, [2.0, 2.0, 2.0, 0.0]), (True, [0.0] * 4)]  # only the text that fails


def test_embedding_of_text_lists(spark):
    df = spark.createDataFrame([(1, ["a b", "", "c"]), (2, []), (3, None), (4, ["c"])], "k int, ts array<string>")
    got = {r.k: r.embeddings for r in emb.embed_lists(df, "k", "ts", 8).collect()}
    one = {r.t: r.embedding for r in emb.embed(spark.createDataFrame(
        [("a b",), ("",), ("c",)], "t string"), "t", 8).collect()}
    assert got == {1: [one["a b"], one[""], one["c"]], 2: [], 3: None, 4: [one["c"]]}
