"""Indexes of the retrieval part against plain scans: neighbour graph, lists with
early stop and codes, block-max search, metadata postings, prefix-filtered join."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions import jsonb
from quarry.functions import trigram as tg
from quarry.operators import blockmax, graph, ivf, meta_index

DIM = 16


def clustered(n, clusters, seed=1, spread=0.15):
    rng = np.random.default_rng(seed)
    cents = rng.standard_normal((clusters, DIM))
    cents /= np.linalg.norm(cents, axis=1, keepdims=True)
    v = cents[np.arange(n) % clusters] + spread * rng.standard_normal((n, DIM)) / np.sqrt(DIM)
    return v.astype(np.float32)


def frame(spark, v, extra=()):
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + list(extra)
    return spark.createDataFrame(rows, "id long, embedding array<float>")


def nearest(v, i, k):
    m = v.astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - m @ m[i]
    return np.lexsort((np.arange(len(v)), d))[:k], np.sort(d)[:k]


def recall(v, rows, k):
    hit = wanted = 0
    by = {}
    for r in rows:
        by.setdefault(r.qid, []).append(r.dist)
    for i, dists in by.items():
        _, d = nearest(v, i, k)
        hit += sum(x <= d[-1] + 1e-6 for x in dists)
        wanted += k
    return hit / wanted


def test_graph_recall_and_bounds(spark, scratch):
    v = clustered(2_000, 25)
    df = frame(spark, v, [(9_000, [0.0] * DIM), (9_001, None)])
    graph.build(df, scratch + "/g", degree=10, rounds=4)
    edges = spark.read.parquet(scratch + "/g/edges")
    most = edges.groupBy("id").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 10 + graph.LINKS
    assert edges.where("id = nb OR id >= 9000 OR nb >= 9000").count() == 0
    for e in edges.limit(50).collect():
        a, b = v[e.id].astype(float), v[e.nb].astype(float)
        assert abs(e.dist - (1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b))) < 1e-6
    queries = df.where("id % 50 = 0").select(F.col("id").alias("qid"), "embedding")
    rows = graph.search(spark, scratch + "/g", queries, 10, beam=30, width=6).collect()
    assert {r.qid for r in rows} == set(range(0, 2_000, 50))
    assert recall(v, rows, 10) >= 0.9
    assert np.mean([r.compared for r in rows]) < 500
    assert sorted(r["rank"] for r in rows if r.qid == 0) == list(range(1, 11))


def test_graph_of_few_vectors(spark, scratch):
    df = frame(spark, clustered(3, 3))
    graph.build(df, scratch + "/g")
    queries = df.select(F.col("id").alias("qid"), "embedding")
    rows = graph.search(spark, scratch + "/g", queries, 5).collect()
    assert sorted((r.qid, r.id) for r in rows) == [(a, b) for a in range(3) for b in range(3)]


def test_lists_stop_early_and_are_exact(spark, scratch):
    v = clustered(3_000, 30)
    v[7] = v[8]
    df = frame(spark, v, [(9_000, [0.0] * DIM), (9_001, None)])
    lists = ivf.build(df, scratch + "/l", 30)
    queries = df.where("id % 50 = 0 OR id >= 9000").select(F.col("id").alias("qid"), "embedding")
    rows = ivf.exact(spark, lists, queries, 10).collect()
    for i in range(0, 3_000, 50):
        want, d = nearest(v, i, 10)
        got = sorted((r for r in rows if r.qid == i), key=lambda r: r["rank"])
        assert [r.id for r in got] == want.tolist()
        assert np.allclose([r.dist for r in got], d, atol=1e-9)
    read = {r.qid: r.lists_read for r in rows}
    assert set(read) == set(range(0, 3_000, 50)) and np.mean(list(read.values())) < 10
    few = ivf.exact(spark, lists, queries.where("qid < 100"), 5_000).collect()  # more than there are
    assert len(few) == 2 * 3_000 and {r.lists_read for r in few} == {30}


def test_exact_lists_of_random_vectors(spark, scratch):
    v = np.random.default_rng(4).standard_normal((400, DIM)).astype(np.float32)
    df = frame(spark, v)
    lists = ivf.build(df, scratch + "/l", 8)
    rows = ivf.exact(spark, lists, df.where("id % 50 = 0").select(F.col("id").alias("qid"), "embedding"), 7).collect()
    for i in range(0, 400, 50):
        assert [r.id for r in sorted((r for r in rows if r.qid == i), key=lambda r: r["rank"])] \
            == nearest(v, i, 7)[0].tolist()


def test_coded_lists_at_the_reference_setting(spark, scratch):
    """400 lists, 50 probes."""
    v = clustered(8_000, 400, spread=0.4)
    df = frame(spark, v)
    lists = ivf.build(df, scratch + "/c", 400, subspaces=8, codewords=64)
    t = spark.read.parquet(scratch + "/c")
    assert t.agg(F.max(F.length("code"))).first()[0] == 8 and t.count() == 8_000
    queries = df.where("id % 50 = 0").select(F.col("id").alias("qid"), "embedding")
    rows = ivf.coded(spark, lists, queries, 10, 50, 60).collect()
    assert recall(v, rows, 10) >= 0.9
    assert np.mean([r.coded for r in rows]) < 8_000 / 4 and {r.scored for r in rows} == {60}


def test_block_max_equals_a_scan_and_reads_less(spark, scratch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    pick = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(words, pick, k=rng.randint(0, 80))) for _ in range(1_500)]
    texts += [texts[3]] * 40 + ["", None, "rare1 rare2 rare1 w0", "rare1 w0"] + ["rare3 rare4 w9"] * 15
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, t string")
    blockmax.build(docs.repartition(4), scratch + "/b", "doc", "t", block_docs=8)
    asked = [(0, ["rare1", "w0", "rare2", "rare1"]), (1, ["w350", "w1", "w300"]), (2, ["unknown"]), (3, []), (4, ["w0"]),
             (5, ["rare3", "w0", "rare4", "w1"])]
    queries = spark.createDataFrame(asked, "qid long, lexemes array<string>")
    top, told = blockmax.search(spark, scratch + "/b", queries, "doc", 10, first_blocks=4)
    got = {}
    for r in top.collect():
        got.setdefault(r.qid, {})[r["rank"]] = (r.doc, r.score)
    for qid, lexs in asked:
        if not lexs:
            assert qid not in got
            continue
        mr = ft.match_rank(ft.websearch_query(" or ".join(dict.fromkeys(lexs))), ft.text_vector(F.col("t")))
        full = docs.select("doc", mr.alias("m")).where("m.match").select("doc", F.round("m.rank", 9).alias("s"))
        want = [(r.doc, r.s) for r in full.orderBy(F.desc("s"), "doc").limit(10).collect()]
        mine = [got.get(qid, {}).get(i + 1) for i in range(len(want))]
        assert [m[0] for m in mine] == [w[0] for w in want] and len(got.get(qid, {})) == len(want)
        assert np.allclose([m[1] for m in mine], [w[1] for w in want], atol=2e-9)
    read = {r.qid: (r.read, r.postings) for r in told.collect()}
    # frequent words count as much as rare ones here, so bounds fall slowly
    assert read[5][0] < 0.6 * read[5][1] and all(a <= b for a, b in read.values())


META = [{"a": 1, "b": {"c": "x", "d": [1, 2, {"e": None}]}, "lang": "en"}, {"a": 1.0, "lang": "en"}, {"a": "1"}, {},
        {"b": {"d": [2, 1]}}, {"a": True, "é": "ü"}, [1, 2], "text", None, {"b": {"c": ["x"]}}] + [{"lang": "en", "n": i} for i in range(60)]


@pytest.mark.parametrize("pushed", [0, 1_000])
def test_metadata_index_equals_the_test(spark, scratch, pushed):
    rows = [(i, json.dumps(m)) for i, m in enumerate(META)] + [(900, None), (901, "{broken")]
    docs = spark.createDataFrame(rows, "doc long, meta string")
    meta_index.build(docs, scratch + "/m", "doc", "meta")
    for f in ({"lang": "en"}, {"a": 1}, {"a": "1"}, {"a": True}, {"b": {"c": "x"}}, {"b": {"d": [1]}}, {"b": {"d": [2, 1]}},
              {"b": {"d": [{"e": None}]}}, {"é": "ü"}, {"lang": "en", "n": 7}, {"zz": 1}, {}, {"b": {}}):
        want = {r.doc for r in docs.where(jsonb.json_contains(F.col("meta"), f)).collect()}
        got = [r.doc for r in meta_index.contains(docs, scratch + "/m", f, "doc", "meta", pushed).collect()]
        assert sorted(got) == sorted(want), f
        found = meta_index.candidates(spark, scratch + "/m", f, "doc")
        assert found is None or want <= {r.doc for r in found.collect()}
    assert meta_index.candidates(spark, scratch + "/m", {"lang": "en", "n": 7}, "doc").count() == 1
    hit = meta_index.contains(docs, scratch + "/m", {"lang": "en", "n": 7}, "doc", "meta")
    assert "doc" in str(hit._jdf.queryExecution().optimizedPlan())


def test_prefix_filter_forms_few_candidates(spark):
    rng = random.Random(6)
    names = [" ".join(rng.choices(["small", "big", "blue", "red", "iron", "steel", "ring", "bolt", "gear", "nut"], k=3))
             + f" {rng.choice('abcdefgh')}{i % 97}" for i in range(400)] + ["", "x"]
    df = spark.createDataFrame([(n,) for n in set(names)], "v string")
    terms = df.select(F.col("v").alias("term"))
    freq = terms.select(F.explode(tg.grams(F.col("term"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    left, right = tg._ranked(df, "v", freq), tg._ranked(terms, "term", freq)
    sets = {n: set(tg.py_grams(n)) for n in set(names)}
    for t in (0.5, 0.8):
        pairs = {tuple(r) for r in tg.join_candidates(left, "v", right, "term", t).collect()}
        similar = {(a, b) for a in sets for b in sets if sets[a] | sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}
        sharing = sum(1 for a in sets for b in sets if sets[a] & sets[b])
        assert similar <= pairs and len(pairs) < sharing / 2


def test_grid_equals_the_passes(spark):
    from quarry.operators import ann
    v = clustered(300, 7)
    v[5] = v[6]
    df = frame(spark, v, [(9_000, [0.0] * DIM), (9_001, None), (9_002, [1.0] * 3)])
    queries = df.where("id % 30 = 0 AND embedding IS NOT NULL").select(F.col("id").alias("qid"), "embedding")
    for limit in (None, 0.5):
        want, got = (sorted((r.qid, r["rank"], r.id, str(r.dist if r.dist is None else round(r.dist, 12))) for r in f.collect())
                     for f in (ann.batch_knn(df, queries, 8, max_dist=limit),
                               ann.grid_knn(df, queries, 8, max_dist=limit, cell_rows=40, cell_queries=3)))
        assert got == want and len(got) > 50
    assert ann.grid_knn(df, queries.limit(0), 8).count() == 0


def test_cooccurrence_thesaurus(spark):
    from quarry.operators import expansion, thesaurus
    rng = random.Random(7)
    texts = []
    for i in range(400):
        animal, verb = rng.choice([("cat", "purrs"), ("feline", "purrs"), ("dog", "barks"), ("hound", "barks")])
        texts.append(f"the {animal} {verb} at {rng.choice(['noon', 'night', 'home'])}")
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "t string")
    asked = spark.createDataFrame([("cat",), ("hound",), ("unknown",)], "token string")
    found = thesaurus.build(df, "t", asked, k=1, contexts=20, least=10)
    assert {(r.token, r.lemma) for r in found.collect()} == {("cat", "feline"), ("hound", "dog")}
    expanded = expansion.expand_queries(spark.createDataFrame([(1, "cat")], "q long, t string"), "q", "t", found)
    assert expanded.first().expanded == "cat feline"


def test_meetings_tell_only_what_is_new(spark):
    """Two that met at a place before are not compared again, nor is told what is
    farther than an id's list reaches."""
    v = clustered(6, 1)
    rows = [(1, i, v[i].tolist(), i == 5, 2.0) for i in range(6)] + [(2, i, v[i].tolist(), False, 2.0) for i in range(6)]
    schema = "at long, id long, v array<float>, fresh boolean, far double"
    met = {(r.id, r.nb) for r in graph._meetings(spark.createDataFrame(rows, schema), 16).collect()}
    assert met == {(i, 5) for i in range(5)} | {(5, i) for i in range(5)}
    near = [(1, i, v[i].tolist(), True, -1.0 if i else 2.0) for i in range(6)]
    assert {r.id for r in graph._meetings(spark.createDataFrame(near, schema), 16).collect()} == {0}


def test_words_of_few_documents_at_a_time():
    """A batch of any size is read in slices: its words are not all Python objects
    at once."""
    import pyarrow as pa
    from quarry.functions.util import slices
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_201))], ["a"])
    parts = list(slices([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in parts] == [500, 500, 201]
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(1_201))


def test_postings_of_a_large_batch(spark):
    from quarry.operators import index as ix
    df = spark.range(1_300).coalesce(1).select("id", F.concat(F.lit("a b a w"), F.col("id").cast("string")).alias("t"))
    sizes = ix.postings(df, "id", "t").where("lexeme = 'a'")
    assert sizes.count() == 1_300 and sizes.where("n <> 2 OR positions <> array(1, 3)").isEmpty()


def test_document_vectors_are_made_once(spark, scratch, monkeypatch):
    from quarry.operators import embedding as emb
    from quarry.plans import retrieval_queries as rq
    rows = [(i, f"word{i % 7} and more") for i in range(60)] + [(60, ""), (61, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(scratch + "/documents.parquet")
    made = spark.sparkContext.accumulator(0)

    def counting(dim):
        @F.udf("array<float>")
        def one(text):
            made.add(1)
            return [float(bool(text))] + [0.0] * (dim - 1)
        return one

    monkeypatch.setattr(emb, "hash_embedder", counting)
    e, queries = rq._stored_vectors(spark, scratch)
    assert e.count() == 60 and queries.count() == 2 and made.value == 62


def test_files_of_lists_follow_the_rows(spark, scratch):
    df = frame(spark, clustered(4_000, 100))
    lists = ivf.build(df, scratch + "/l", 100)
    t = spark.read.parquet(scratch + "/l")
    assert len(t.inputFiles()) <= 8 and t.count() == lists.sizes.sum() == 4_000  # the session's partitions
    assert [lists.sizes[r.list_id] for r in t.groupBy("list_id").count().collect()] \
        == [r["count"] for r in t.groupBy("list_id").count().collect()]


def test_candidates_of_lists_beyond_the_kth_stay_in_the_task(spark, scratch):
    from quarry.operators import ann
    v = clustered(500, 5)
    lists = ivf.build(frame(spark, v), scratch + "/l", 5)
    t = spark.read.parquet(scratch + "/l")
    kth = np.array([nearest(v, i, 10)[1][2] for i in (0, 1)])
    for want in (np.array([0, 1]), ann.wanted_rows(np.ones(2, bool))):
        found = ann.list_candidates(t, {i: want for i in range(5)}, v[:2].astype(float), np.array([0, 1]), 10,
                                    vec_col="v", far=kth + 1e-9).collect()
        assert sorted((r.qid, r.id) for r in found) == sorted((i, j) for i in (0, 1) for j in nearest(v, i, 3)[0])
    mask = np.random.default_rng(3).random(100) < 0.5
    assert ann.wanted_rows(mask).dtype == np.uint8
    assert ann.asked_rows(ann.wanted_rows(mask), 100).tolist() == np.flatnonzero(mask).tolist()


def test_lists_of_no_vectors(spark, scratch):
    df = frame(spark, [], [(1, [0.0] * DIM), (2, None)])
    queries = df.select(F.col("id").alias("qid"), "embedding")
    lists = ivf.build(df, scratch + "/l", 4)
    assert ivf.exact(spark, lists, queries, 3).count() == 0


def test_texts_of_the_block_index_are_counted_once(spark, scratch, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 5} w{i % 3} w0") for i in range(90)] + [(90, None), (91, "")],
                                 "doc long, t string")
    read, plain = spark.sparkContext.accumulator(0), blockmax.slices

    def counting(batches):
        for b in plain(batches):
            read.add(b.num_rows)
            yield b

    monkeypatch.setattr(blockmax, "slices", counting)
    blockmax.build(docs, scratch + "/b", "doc", "t")
    assert read.value == 92
    got = {(r.doc, r.lexeme): (r.n, r.impact) for r in spark.read.parquet(scratch + "/b/postings").collect()}
    assert got[(0, "w0")] == (3, (1 + 1 / 4 + 1 / 9) / ft.ZETA2) and (90, "") not in got
    assert sum(n for n, _ in got.values()) == 270


def test_pairs_of_words_are_combined_in_the_batch():
    import collections
    import pyarrow as pa
    from quarry.operators import thesaurus
    rng = random.Random(8)
    texts = [rng.choices("abcdefg", k=rng.randint(0, 30)) for _ in range(40)] + [None, [], ["a"]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.list_(pa.string()))], ["w"])
    for window in (1, 2, 3):
        want = collections.Counter((w, "gbz".index(t[j])) for t in texts if t for i, w in enumerate(t)
                                   for j in range(max(0, i - window), min(len(t), i + window + 1)) if j != i and t[j] in "gb")
        rows = [r for b in thesaurus._near(["g", "b", "z"], window)([batch]) for r in b.to_pylist()]
        assert {(r["word"], r["i"]): r["n"] for r in rows} == want and len(rows) == len(want)


def test_graph_moves_no_vector_to_each_meeting(spark, scratch, monkeypatch):
    """A vector comes to a cell once however many meet there, lists are rows, not
    pairs, and a small cluster far from all others is found."""
    v = np.concatenate([clustered(3_000, 3), clustered(30, 1, seed=9, spread=0.05) * -1])
    told, plain = [], graph._met

    def counting(around, points, lists, degree):
        met = plain(around, points, lists, degree)
        told.append((met.columns, met.groupBy("id").count().agg(F.max("count")).first()[0] or 0))
        return met

    monkeypatch.setattr(graph, "_met", counting)
    df = frame(spark, v, [(9_000, [0.0] * DIM), (9_001, None)])
    graph.build(df, scratch + "/g", degree=8, rounds=2)
    cells = graph._centres(spark.read.parquet(scratch + "/g/points"), len(v)).shape[0]
    assert told and all(c == ["id", "nb", "dist"] and most <= cells for c, most in told)
    queries = df.where("id % 50 = 0 OR id >= 3000").select(F.col("id").alias("qid"), "embedding")
    rows = graph.search(spark, scratch + "/g", queries, 10, beam=30, width=6).collect()
    assert {r.qid for r in rows} == {*range(0, 3_000, 50), *range(3_000, 3_030)}
    assert recall(v, rows, 10) >= 0.9


def test_graph_search_keeps_more_than_its_beam_and_one_query_of_an_id(spark, scratch):
    v = clustered(300, 2)
    graph.build(frame(spark, v), scratch + "/g")
    queries = frame(spark, v[:2], [(0, v[0].tolist()), (None, v[0].tolist())]).select(F.col("id").alias("qid"), "embedding")
    rows = graph.search(spark, scratch + "/g", queries, 20, beam=16, width=3).collect()
    assert sorted((r.qid, r["rank"]) for r in rows) == [(q, i) for q in (0, 1) for i in range(1, 21)]
    empty = frame(spark, v[:0], [(1, [0.0] * DIM)])
    graph.build(empty, scratch + "/e")
    assert graph.search(spark, scratch + "/e", queries, 5).count() == 0
