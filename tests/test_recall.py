"""Recall of the approximate searches that the registered queries make."""

import numpy as np

from quarry.operators import ann
from quarry.plans import ranking_queries as rq
from quarry.plans.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_recall_over_all_queries(spark):
    e, queries = rq._vectors(spark, SF)
    rows = e.collect()
    ids = np.array([r.id for r in rows])
    m = np.array([r.embedding for r in rows], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    asked = np.nonzero(ids % 50 == 0)[0]
    near = {ids[i]: set(ids[np.lexsort((ids, 1 - m @ m[i]))[:50]]) for i in asked}
    path, cents = rq._ivf_index(spark, SF)
    for found in (ann.ivf_batch(spark, path, cents, queries, 50, rq.PROBES), ann.lsh_batch(e, queries, 50)):
        got = {}
        for r in found.collect():
            got.setdefault(r.qid, set()).add(r.id)
        assert set(got) == set(near) and all(len(g) == 50 for g in got.values())
        assert sum(len(got[i] & near[i]) for i in near) >= 0.9 * 50 * len(near)
    one = {r.id for r in QUERIES["ivf_probe"](spark, SF).collect()}
    batch = ann.ivf_batch(spark, path, cents, queries.where("qid = 0"), 50, rq.PROBES)
    assert one == {r.id for r in batch.collect()}


def test_a_search_of_few_lists_fails_the_floor(spark):
    e, queries = rq._vectors(spark, SF)
    path, cents = rq._ivf_index(spark, SF)
    row = rq._recall(e, queries, ann.ivf_batch(spark, path, cents, queries, 50, 4), 0.9).first()
    assert row.n == 50 and row.exact and not row.recall_ok
    for name in ("ivf_recall", "lsh_recall"):
        assert QUERIES[name](spark, SF).collect() == [(50, True, True)]
