import math
import random
import re
from collections import Counter

import numpy as np

from quarry.llm import lexical, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def low(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(low(t))) for d, t in docs if low(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            n = sum(c.values())
            m = 100 - 90 + 90 * n * n_docs // n_terms
            scored.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                               * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(low(text)) if t in c), d))
        best = sorted((s for s in scored if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
        out += [(item, i, d, s) for i, (s, d) in enumerate(best, 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def corpus(n=900):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "A1", "日本"]
    pick = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, pick, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(200)]  # a group of copies
    docs += [(5_000, None), (5_001, ""), (5_002, "-- ..!"), (None, docs[3][1]), (5_003, "w1 " * 100_000),
             (5_004, docs[9][1]), (5_004, docs[9][1]), (5_005, "É é É")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(30)]
    items += [(30, None), (31, "??"), (32, "w0"), (32, "w0"), (33, docs[7][1]), (34, "unknown w1 W1"), (35, "é"), (None, "w5")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, segment int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return d, q


def test_against_brute_force(spark):
    docs, items = corpus()
    expected = brute(docs, items)
    d, q = frames(spark, docs, items)
    assert rows(lexical.rank(d.repartition(3), q)) == expected
    # several groups of queries, many small segments and blocks
    assert rows(lexical.rank(d.repartition(5), q, most_terms=40, cells=4_000, block=4)) == expected


def test_query_and_empty_tables(spark, write_tables, make_docs):
    docs, items = corpus(100)
    d, q = frames(spark, docs, items)
    assert rows(queries.op11_block_search(spark, write_tables(documents=d, benchmark=q))) == brute(docs, items)
    none = make_docs([])
    assert lexical.rank(none, q).count() == lexical.rank(d, q.limit(0)).count() == 0
    assert lexical.rank(make_docs([None, "!!"]), q).count() == 0


def test_blocks_are_skipped_and_bounds_hold():
    rng = np.random.default_rng(1)
    topics = rng.random((100, 200)) < 0.06
    matrix = np.zeros((2_000, 200), np.float32)
    for i in range(2_000):
        own = np.flatnonzero(topics[i % 100])
        matrix[i, own] = rng.integers(500_000, 999_999, len(own)) * (rng.random(len(own)) < 0.8)
    weights = rng.integers(1, 9_000, 200)
    asked = lexical.together([np.flatnonzero(t) for t in topics])
    matrix[:, [t for t in range(200) if t not in asked]] = 0
    blocks = list(lexical.block_lists(matrix, weights, asked, 16))
    lists = {}
    for term, members, at, steps in blocks:
        assert 0 < len(members) <= 16
        most = matrix[members].max(axis=0)
        assert set(at) == set(np.flatnonzero(most)) & set(asked[term]) and (most[at] <= steps * 3922.0).all()
        lists.setdefault(term, []).extend(members.tolist())
    for term in range(200):
        assert sorted(lists.get(term, [])) == np.flatnonzero(matrix[:, term]).tolist()
    summaries = np.zeros((len(blocks), 200), np.uint8)
    for i, (_, _, at, steps) in enumerate(blocks):
        summaries[i, at] = steps
    segment = lexical.Segment(list(range(2_000)), matrix, np.array([b[0] for b in blocks]),
                              [b[1] for b in blocks], summaries)
    scored = 0
    for topic in range(100):
        of = np.flatnonzero(topics[topic])
        for w in (weights[of].astype(np.float64), weights[of]):
            got, scores, n = segment.search(of, w, 10, 0)
            true = matrix[:, of].astype(np.int64) @ weights[of]
            order = np.lexsort((np.arange(2_000), -true))[:10]
            assert got.tolist() == order.tolist() and scores.tolist() == true[order].tolist()
        scored += n
    held = sum(int((matrix[:, np.flatnonzero(t)] > 0).any(axis=1).sum()) for t in topics)
    assert scored < held / 2  # of the documents that hold a term of the query
