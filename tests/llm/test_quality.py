import itertools

import numpy as np
import pytest

from quarry.llm import quality as q
from quarry.llm import queries

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    n_lines = np.array([3, 1, 5, 3])
    emit, move = rng.normal(size=12), rng.normal(size=(2, 2))
    chains = q.Chains(n_lines)
    p, z, pairs = chains.marginals(emit, move)
    want_pairs, at = np.zeros((2, 2)), 0
    for k, n in enumerate(n_lines):
        weights = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            s = sum(emit[at + i] for i in range(n) if y[i]) + sum(move[a, b] for a, b in zip(y, y[1:]))
            weights[y] = np.exp(s)
        total = sum(weights.values())
        assert z[list(chains.order).index(k)] == pytest.approx(np.log(total))
        for i in range(n):
            good = sum(w for y, w in weights.items() if y[i]) / total
            assert p[at + i, 1] == pytest.approx(good)
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w / total
        at += n
    assert np.allclose(pairs, want_pairs)


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"One line.\nTwo | lines\n\n!!", "Ünïcode — x\n".encode() * 40, b"\n\n", b"a" * 9000]
    x, w, n = q.line_features(texts)
    assert n.tolist() == [1, 4, 41, 3, 1]
    parts = [q.line_features([t]) for t in texts]
    assert np.allclose(x, np.concatenate([p[0] for p in parts]))
    assert np.allclose(w, np.concatenate([p[1] for p in parts]))
    line = q.line_features([b"ab CD 12"])[0][0, 1:1 + q._CLASSES]
    assert np.allclose(line[:4] ** 2 * 8, [2, 2, 2, 2])


def test_held_out_quality(spark):
    got = queries.op2_quality_crf(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    m = got[got["held_out"]].merge(labels, on="doc_id")
    assert (m["predicted"] == m["quality"]).mean() >= 0.97
    assert (m[m["quality"] == 0]["predicted"] == 0).mean() >= 0.85


def test_edge_rows(spark, make_docs):
    docs = make_docs([None, "", "x", "x", "long line " * 60_000]).selectExpr("*", "1 AS score", "2 AS _score")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(2, 1), (2, 0), (3, None), (None, 0)], "doc_id long, quality int")
    for labels in (none, one):
        model = q.train(docs, labels)
        rows = q.score(docs, model, "new").collect()
        assert len(rows) == 5 and all(0 <= r.new <= 1 for r in rows)
        kept = q.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 5
    assert {r.new for r in q.score(docs, q.train(docs, none), "new").collect()} == {0.5}
    assert q.score(docs.limit(0), q.train(docs, none), "new").count() == 0


def test_gradient_of_the_fit_by_differences(monkeypatch):
    """One step of ``fit`` from zero goes along the gradient of the likelihood."""
    rng = np.random.default_rng(3)
    n_lines, label = np.array([3, 1, 4, 2]), np.array([1, 0, 1, 0])
    x = rng.normal(size=(10, 4))
    y = np.repeat(label, n_lines)
    move = rng.normal(size=(2, 2))
    w = rng.normal(size=4)

    def likelihood(theta):
        w, move = theta[:4], theta[4:].reshape(2, 2)
        _, z, _ = q.Chains(n_lines).marginals(x @ w, move)
        own = (y * (x @ w)).sum() + sum((n - 1) * move[k, k] for n, k in zip(n_lines, label))
        return own - z.sum()

    theta = np.concatenate([w, move.ravel()])
    p, _, pairs = q.Chains(n_lines).marginals(x @ w, move)
    held = np.diag([(n_lines - 1)[label == 0].sum(), (n_lines - 1)[label == 1].sum()])
    grad = np.concatenate([x.T @ (y - p[:, 1]), (held - pairs).ravel()])
    for i in range(8):
        step = np.zeros(8)
        step[i] = 1e-5
        assert (likelihood(theta + step) - likelihood(theta - step)) / 2e-5 == pytest.approx(grad[i], abs=1e-5)
    # the fitted weights beat the start and a small change of any of them
    monkeypatch.setattr(q, "DECAY", 0.0)
    x1 = np.column_stack([np.ones(10), rng.normal(size=(10, 3))])
    y1 = rng.integers(0, 2, 4)
    model = q.fit(x1, n_lines, y1, steps=3_000)
    scaled, lab = model.scaled(x1), np.repeat(y1, n_lines)

    def fitted(theta):
        w, move = theta[:4], theta[4:].reshape(2, 2)
        _, z, _ = q.Chains(n_lines).marginals(scaled @ w, move)
        return (lab * (scaled @ w)).sum() + sum((n - 1) * move[k, k] for n, k in zip(n_lines, y1)) - z.sum()

    end = np.concatenate([model.weights, model.move.ravel()])
    assert fitted(end) > fitted(np.zeros(8))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 10, 97, 1_000])
def test_long_chains_equal_short_ones(n):
    rng = np.random.default_rng(n)
    emit, move = rng.normal(size=n) * 3, rng.normal(size=(2, 2))
    p, _, _ = q.Chains(np.array([n])).marginals(emit, move)
    assert np.allclose(q.long_marginals(emit, move), p[:, 1], atol=1e-12)


def test_features_in_chunks_are_the_same():
    rng = np.random.default_rng(5)
    lines = [b"", b"one | two", b"ABC, 12", "\u00e9\u00fc x".encode(), b"long " * 40]
    for n in (1, 2, 6, 7, 8, 50):
        text = b"\n".join(lines[i] for i in rng.integers(0, 5, n))
        x, w, _ = q.line_features([text])
        for size in (1, 3, 7, 100):
            parts = list(q.chunk_features(text, size))
            assert np.allclose(np.concatenate([p[0] for p in parts]), x)
            assert np.allclose(np.concatenate([p[1] for p in parts]), w)


def test_texts_of_very_many_lines(monkeypatch):
    import resource
    import time
    rng = np.random.default_rng(6)
    model = q.Model(np.zeros(q.WIDTH), np.ones(q.WIDTH), rng.normal(size=q.WIDTH) / 5, rng.normal(size=(2, 2)))
    text = b"\n".join(b"line %d | x" % (i % 977) for i in range(5_000))
    (long,) = model.scores([text])
    monkeypatch.setattr(q, "CHUNK_LINES", 10_000)
    short = model.scores([b"", text, b"x"])
    assert short[1] == pytest.approx(long, abs=1e-9)
    monkeypatch.undo()
    assert np.allclose(model.scores([b"", text, b"x"]), short)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    start = time.time()
    model.scores([b"\n".join(b"line %d | xyz" % i for i in range(500_000))])
    assert time.time() - start < 30
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_sample_is_one_row_a_doc_id_within_the_budget(spark):
    rows = [(7 if i % 3 == 0 else i, "\n".join(f"row {i} {k}" for k in range(i % 9 + 1))) for i in range(3_000)]
    docs = spark.createDataFrame(rows + [(4_000, "x\n" * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0), (10, 1), (4_000, 0), (5_000, 1)], "doc_id long, quality int")
    got = q.sample(docs, labels, chunk_lines=400).collect()
    assert len(got) == 4 and max(r.n for r in got) == 400  # the long one teaches, too
    every = spark.createDataFrame([(i, i % 2) for i in range(3_000)], "doc_id long, quality int")
    some = q.sample(docs, every, sample_lines=500).collect()
    assert 400 < sum(r.n for r in some) <= 500
    assert q.sample(docs, every, sample_lines=0).count() == 0
