"""Batch search (Q9 over Q7 / Q8): every query of a batch gets exactly what
the single search gives it, for every kind of text query."""

import math

import numpy as np
import pytest

from quarry.functions import fulltext as ft
from quarry.operators import ann
from quarry.operators import batch_search as BS
from quarry.operators import search as S

ROWS = [
    (1, "the cat sat at home by the door", '{"lang": "en"}', [1.0, 0.0]),
    (2, "a dog by the door at night", '{"lang": "en"}', [0.9, 0.1]),
    (3, "at by at by", '{"lang": "de"}', [0.0, 1.0]),
    (4, "nothing here at all", '{"lang": "en"}', [-1.0, 0.0]),
    (5, "zero vector at by", '{"lang": "en"}', [0.0, 0.0]),
    (6, "by at the cat", '{"lang": "en", "tags": ["x"]}', [0.7, 0.7]),
    (7, "the door, the door and the cat", '{"lang": "fr"}', [0.5, -0.5]),
]

QUERIES = [
    (10, [1.0, 0.0], "at by"),
    (11, [0.0, 1.0], '"at by"'),
    (12, [0.6, 0.8], "cat or dog"),
    (13, [1.0, 1.0], "at -cat"),
    (14, [0.2, -1.0], None),
    (15, [1.0, 0.2], ""),
    (16, [-0.3, 0.9], "the door"),
    (17, [0.9, 0.1], '"the door" or -nothing'),
    (18, [0.5, 0.5], "en"),
    (19, [1.0, 0.0], "sat_at%"),
]


def chunks(spark):
    return spark.createDataFrame(ROWS, "id long, content string, metadata string, embedding array<float>")


def queries(spark):
    return spark.createDataFrame(QUERIES, "qid long, embedding array<float>, text string")


def _rows(df):
    return sorted((r.id, None if r.score is None else round(r.score, 9)) for r in df.collect())


def f32(v):
    """The query vector as the batch reads it from an ``array<float>`` column."""
    return [float(np.float32(x)) for x in v]


def _same(a, b):
    assert [x[0] for x in a] == [x[0] for x in b]
    for (_, s), (_, t) in zip(a, b):
        assert (math.isnan(s) and math.isnan(t)) or s == pytest.approx(t, abs=1e-9)


@pytest.mark.parametrize("kw", [
    dict(match_count=3, pool_multiplier=2),
    dict(match_count=4, pool_multiplier=1, filter={"lang": "en"}),
    dict(match_count=7, pool_multiplier=1, min_score=-5.0),
])
def test_batch_equals_single_hybrid(spark, kw):
    got = BS.batch_search(chunks(spark), queries(spark), dims=(2,), **kw)
    for qid, vec, text in QUERIES:
        one = S.match_hybrid(chunks(spark), f32(vec), text, dims=(2,), **kw)
        _same(_rows(got.where(got.qid == qid)), _rows(one))


def test_batch_equals_single_precise(spark):
    kw = dict(match_count=3, pool_multiplier=2, min_cos_sim=0.5, min_score=0.2)
    got = BS.batch_search(chunks(spark), queries(spark), dims=(2,), metric="inner", **kw)
    for qid, vec, text in QUERIES:
        one = S.match_precise(chunks(spark), f32(vec), text, dims=(2,), **kw)
        _same(_rows(got.where(got.qid == qid)), _rows(one))


def test_ranks_are_dense_per_query(spark):
    got = BS.batch_search(chunks(spark), queries(spark), match_count=3, pool_multiplier=2,
                          dims=(2,)).collect()
    by = {}
    for r in got:
        by.setdefault(r.qid, []).append(r.rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values())


def test_parsed_query_shapes():
    assert ft.parsed_query(None) is None
    p = ft.parsed_query("a b or -c \"d e\"")
    assert p["lexemes"] == ["a", "b", "c", "d", "e"]
    assert [[(o["neg"], o["phrase"], o["lexemes"]) for o in g] for g in p["groups"]] == [
        [(False, True, ["a"]), (False, True, ["b"])],
        [(True, True, ["c"]), (False, True, ["d", "e"])]]
    assert p["use_and"] is False
    assert ft.parsed_query('"x y"')["use_and"] is True
    assert ft.parsed_query("")["groups"] == []


def test_mixed_dimensions_refused(spark):
    qs = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [1.0, 0.0, 0.0], "b")],
                               "qid long, embedding array<float>, text string")
    with pytest.raises(ValueError):
        BS.batch_search(chunks(spark), qs, dims=(2, 3))


def test_null_and_zero_vectors_order_like_single(spark):
    rows = ROWS + [(8, "null vector at by", '{"lang": "en"}', None)]
    df = spark.createDataFrame(rows, "id long, content string, metadata string, embedding array<float>")
    kw = dict(match_count=8, pool_multiplier=1, min_score=-5.0)
    got = BS.batch_search(df, queries(spark), dims=(2,), **kw)
    for qid, v, text in QUERIES:
        one = S.match_hybrid(df, f32(v), text, dims=(2,), **kw)
        _same(_rows(got.where(got.qid == qid)), _rows(one))


def test_many_query_blocks_one_pass(spark):
    """More queries than one product block: same answer as brute force, and
    one scan of the table in the plan."""
    import numpy as np
    from quarry.operators import ann
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(300, 4)).astype(np.float32)
    qs = rng.normal(size=(2500, 4))
    t = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                              "id long, embedding array<float>")
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(qs)],
                              "qid long, embedding array<float>")
    got = {(r.qid, r.rank): r.id for r in ann.batch_knn(t, q, 3).collect()}
    v64 = vecs.astype(np.float64)
    d = 1 - (qs @ v64.T) / (np.linalg.norm(qs, axis=1)[:, None] * np.linalg.norm(v64, axis=1)[None, :])
    for qi in range(0, 2500, 97):
        order = sorted(range(300), key=lambda j: (d[qi, j], j))[:3]
        assert [got[(qi, r)] for r in (1, 2, 3)] == order
    qrows = next(ann.query_blocks(q, ["qid", "embedding"], "qid"))
    plan = ann.knn_candidates(t, qrows, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("Scan parquet") == 1


def test_query_blocks_and_merge_tree(spark):
    """Any number of query blocks, and the two-step merge: same answer."""
    from quarry.operators import ann
    t = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(200)],
                              "id long, embedding array<float>").repartition(12)
    q = spark.createDataFrame([(i, [float(i % 5), 2.0]) for i in range(20)],
                              "qid long, embedding array<float>")
    one = sorted(map(tuple, ann.batch_knn(t, q, 4).collect()))
    many = sorted(map(tuple, ann.batch_knn(t, q, 4, max_query_bytes=100).collect()))
    assert one == many and len(one) == 80
    assert len(list(ann.query_blocks(q, ["qid", "embedding"], "qid", max_bytes=100))) > 3


def test_batch_search_in_blocks(spark):
    from quarry.operators import batch_search as B
    t = spark.createDataFrame([(i, f"w{i % 3} x", "{}", [float(i % 7), 1.0]) for i in range(40)],
                              "id long, content string, metadata string, embedding array<float>")
    q = spark.createDataFrame([(i, [float(i), 2.0], f"w{i % 3}") for i in range(6)],
                              "qid long, embedding array<float>, text string")
    one = sorted(map(tuple, B.batch_search(t, q, dims=(2,)).collect()))
    assert one == sorted(map(tuple, B.batch_search(t, q, dims=(2,), max_query_bytes=40).collect()))
    assert len(one) == 30


def test_few_distances_at_a_time(monkeypatch):
    """The distances in memory are bounded whatever the queries and the size of an
    Arrow batch; the result equals a plain sort, ties, null and zero vectors included."""
    from types import SimpleNamespace

    import pyarrow as pa
    from quarry.operators import vector_scan
    rng = np.random.default_rng(4)
    m = rng.integers(-2, 3, (3_000, 4)).astype(np.float64)
    vectors = [None if i % 97 == 0 else x.tolist() for i, x in enumerate(m)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3_000)), pa.array(vectors, pa.list_(pa.float32()))],
                                       ["id", "v"])
    q = rng.integers(-2, 3, (50, 4)).astype(np.float64)
    seen, own = [], vector_scan.distance_block
    monkeypatch.setattr(ann, "CELLS", 2_000)
    monkeypatch.setattr(vector_scan, "distance_block", lambda a, b, c: seen.append(len(a) * len(b)) or own(a, b, c))
    for metric, most in (("cosine", None), ("inner", None), ("cosine", 0.3)):
        run = ann._topk_block(SimpleNamespace(value=(np.arange(50) * 10, q)), 40, metric, "id", "v", most)
        got = {}
        for b in run([batch.slice(0, 2_500), batch.slice(2_500)]):
            for r in b.to_pylist():
                got.setdefault(r["qid"], []).append((r["tier"], r["id"]))
        d, zero = own(m, q, metric)
        tier = np.where(np.arange(3_000) % 97 == 0, 2, np.where(zero, 1, 0))
        for i in range(50):
            key = np.round(np.where(tier[i] == 0, d[i], 0), 12)
            order = [j for j in np.lexsort((np.arange(3_000), key, tier[i]))
                     if most is None or tier[i, j] == 0 and d[i, j] <= most][:40]
            mine = got.get(i * 10, [])
            assert len(mine) == len(order) and [t for t, _ in mine] == [tier[i, j] for j in order]
            assert np.allclose([key[j] for _, j in mine], [key[j] for j in order])
    assert max(seen) <= 2_000
