"""Public helpers without a registered query of their own: the staged
cascade (S6), the fuzzy test (L12), unit vectors, a plug-in rerank model
(Q13) and the compiled text query (L8, L9)."""

import math

import numpy as np
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions import trigram as tg
from quarry.functions import vectors as vec
from quarry.operators import rerank
from quarry.sources import html


def test_staged_cascade_runs_later_stages_only_on_misses(spark):
    df = spark.createDataFrame([(1, "x" * 150), (2, "short"), (3, "")], "k int, raw string")
    seen = []

    def first(d):
        return d.select("k", F.col("raw").alias("text"))

    def second(d):
        seen.append(d)
        return d.select("k", F.lit("y" * 120).alias("text"))
    out = {r.k: r.stage for r in html.staged_cascade(df, "k", [first, second]).collect()}
    assert out == {1: 0, 2: 1, 3: 1}
    assert sorted(r.k for r in seen[0].collect()) == [2, 3]


def test_fuzzy_match_threshold(spark):
    df = spark.createDataFrame([("small ring",), ("blue bolt",)], "n string")
    got = [r.m for r in df.select(tg.fuzzy_match(F.col("n"), "SMALL").alias("m")).collect()]
    assert got == [True, False]


def test_l2_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    rows = [r.u for r in df.select(vec.l2_normalize(F.col("v")).alias("u")).collect()]
    assert rows[0] == [0.6, 0.8] and rows[1] == [0.0, 0.0]


def test_model_scorer_hook(spark):
    def load():
        return lambda qs, cs: np.array([float(len(c)) for c in cs])
    chunks = spark.createDataFrame([("f", 0, "q", "aa"), ("f", 1, "q", "aaaa"), ("f", 2, "q", "a"),
                                    ("g", 0, "", "aaaaa")], "parent string, chunk_index int, q string, content string")
    out = rerank.rerank(chunks, "parent", F.col("q"), F.col("content"), rerank.model_scorer(load))
    got = sorted((r.parent, r.rerank_pos, r.chunk_index, r.rerank_score) for r in out.collect())
    assert got == [("f", 1, 1, 4.0), ("f", 2, 0, 2.0), ("f", 3, 2, 1.0)]   # empty query: no rerank


def test_compile_query_match_and_rank(spark):
    df = spark.createDataFrame([("a b a",), ("b only",)], "t string")
    tq = ft.text_query("a b")
    m, r = ft.compile_query(tq, ft.text_vector(F.col("t")))
    rows = df.select(m.alias("m"), r.alias("r")).collect()
    assert [x.m for x in rows] == [True, False]
    assert rows[0].r > 0 and not math.isnan(rows[0].r)
