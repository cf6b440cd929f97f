"""Property tests of SURVEY §5 (V2, V5, Q6, Q10) and the plan checks
(partition pruning on the dimension)."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import vectors as vec
from quarry.operators import search as S
from quarry.plans import ingest

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
val = st.floats(min_value=-4, max_value=4, allow_nan=False, width=32)
vec3 = st.lists(val, min_size=3, max_size=3)


@SETTINGS
@given(st.lists(st.lists(val, min_size=0, max_size=7), min_size=1, max_size=6), st.integers(1, 6))
def test_fit_dim_size(spark, vs, dim):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "id int, v array<float>")
    got = {r.id: r.v for r in df.select("id", vec.fit_dim(F.col("v"), dim).alias("v")).collect()}
    for i, v in enumerate(vs):
        want = (v + [0.0] * dim)[:dim]
        assert got[i] == [float(np.float32(x)) for x in want]


@SETTINGS
@given(st.lists(st.tuples(vec3, vec3), min_size=1, max_size=8))
def test_cosine_symmetric_and_bounded(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                               "id int, a array<float>, b array<float>")
    out = df.select("id", vec.cosine_distance(F.col("a"), F.col("b")).alias("ab"),
                    vec.cosine_distance(F.col("b"), F.col("a")).alias("ba")).collect()
    for r in out:
        a, b = (np.asarray(x, dtype=np.float32).astype(np.float64) for x in pairs[r.id])
        if np.linalg.norm(a) * np.linalg.norm(b) == 0:
            assert math.isnan(r.ab) and math.isnan(r.ba)
            continue
        assert abs(r.ab - r.ba) < 1e-12
        assert -1e-9 <= r.ab <= 2 + 1e-9
        assert abs(r.ab - (1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))) < 1e-9


words = st.sampled_from(["at", "by", "the", "cat", "door", "x"])
row = st.tuples(st.lists(words, min_size=0, max_size=8), st.lists(val, min_size=2, max_size=2))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12), st.lists(val, min_size=2, max_size=2),
       st.sampled_from([None, "at by", '"the cat"', "door or x", "-x"]), st.integers(1, 4),
       st.integers(1, 3), st.floats(min_value=-1, max_value=1))
def test_search_result_properties(spark, rows, q, text, k, m, min_score):
    """Q6: at most k rows, sorted by score (descending, then id), every score
    at least the minimum, every row from the pool of k*m; without text the
    scores are the cosine similarities."""
    data = [(i, " ".join(ws), '{"lang": "en"}', e) for i, (ws, e) in enumerate(rows)]
    chunks = spark.createDataFrame(data, "id long, content string, metadata string, embedding array<float>")
    out = S.match_hybrid(chunks, q, text, match_count=k, pool_multiplier=m, min_score=min_score,
                         dims=(2,)).collect()
    assert len(out) <= k
    keys = [(-(r.score if not math.isnan(r.score) else math.inf), r.id) for r in out]
    assert keys == sorted(keys)
    assert all(math.isnan(r.score) or r.score >= min_score for r in out)
    pool = {r.id for r in S.vector_pool(chunks, q, k * m).collect()}
    assert {r.id for r in out} <= pool
    if text is None:
        qv = np.asarray(q, dtype=np.float64)
        for r in out:
            e = np.asarray(rows[r.id][1], dtype=np.float32).astype(np.float64)
            den = np.linalg.norm(e) * np.linalg.norm(qv)
            if den == 0:
                assert math.isnan(r.score)
            else:
                assert abs(r.score - e @ qv / den) < 1e-9


def test_dimension_is_partition_pruned(spark, scratch):
    """Reading one dimension prunes the other partitions of the table."""
    rows = [dict.fromkeys(ingest.CHUNK_SCHEMA.names) | {
        "id": i, "parent": f"p{i}", "chunk_index": 0, "content": "text", "metadata": "{}",
        "embedding": [1.0] * d, "embed_failed": False, "dim": d}
        for i, d in enumerate([384, 768, 384, 1536])]
    df = spark.createDataFrame(rows, ingest.CHUNK_SCHEMA)
    path = scratch + "/chunks"
    ingest.write_chunks(df, path)
    t = ingest.read_chunks(spark, path, 384)
    plan = t.select("id", "embedding")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dim" in plan and "(dim#" in plan
    assert sorted(r.id for r in t.collect()) == [0, 2]
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]    # column pruning
