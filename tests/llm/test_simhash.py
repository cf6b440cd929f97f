import random
import re

import numpy as np
import pytest
import xxhash

from quarry.llm import queries
from quarry.llm import simhash as sh
from quarry.llm.components import components


def brute_fp(text, k=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, fps, bits=2):
    up = {f: f for f in set(fps)}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in up:
        for b in up:
            if (a ^ b).bit_count() <= bits:
                up[root(a)] = root(b)
    least = {}
    for i, f in zip(ids, fps):
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [least.get(root(f)) for f in fps]


def gray_sorted(values):
    r = values.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(k)
    return values[np.argsort(r)]


def planted(seed, n=40):
    """Fingerprints in chains and clusters around few centres."""
    r, out = random.Random(seed), []
    for _ in range(n):
        x = r.getrandbits(64)
        for _ in range(r.randrange(1, 12)):
            out.append(x)
            for _ in range(r.choice([0, 1, 2, 2, 3, 5])):
                x ^= 1 << r.randrange(64)
    return out + [0, (1 << 64) - 1, 1, 3, 7, 15]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b c d e a b c", "Été   É x\x0by",
                                  "w " * 70_000])
def test_fingerprint(text):
    assert sh.fingerprint((text or "").encode()) == brute_fp(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_index_finds_all_pairs(bits):
    v = gray_sorted(np.unique(np.array(planted(7), dtype=np.uint64)))
    index = sh.GrayIndex(np.full(len(v), ~np.uint64(0)), v, fan_out=4)
    q, leaf = index.search(v, bits)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= bits
    assert set(zip(q.tolist(), leaf.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


@pytest.mark.parametrize("block_rows, top, visitors", [
    (16, 65_536, 200_000), (100_000, 65_536, 200_000), (16, 3, 200_000), (16, 2, 9), (16, 65_536, 5)])
def test_links_join_the_same_groups(spark, monkeypatch, block_rows, top, visitors):
    """Also with few top nodes and with visitors in many parts."""
    monkeypatch.setattr(sh, "TOP_NODES", top)
    monkeypatch.setattr(sh, "VISITORS", visitors)
    fps = planted(11)
    signed = [int(np.uint64(f).view(np.int64)) for f in set(fps)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in components(sh.links(df, 2, block_rows)).collect()}
    got = {}
    for s in signed:
        got.setdefault(roots.get(s, s), set()).add(s)
    want = {}
    for f, c in zip(fps, brute_groups(list(range(len(fps))), fps)):
        want.setdefault(c, set()).add(int(np.uint64(f).view(np.int64)))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and len({got[i] for i in range(1000, 1300)}) == 1
    assert got[0] != got[1000] and 5000 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_and_stage(spark, make_docs, write_tables):
    r = random.Random(3)
    base = [" ".join(r.choices([f"w{i}" for i in range(500)], k=300)) for _ in range(12)]
    texts = [None, "", "  \n", "tiny"]
    for t in base:
        texts += [t] * r.randrange(1, 4)
        for _ in range(r.randrange(4)):
            w = t.split()
            w[r.randrange(300)] = "changed"
            texts.append(" ".join(w).upper())
    docs = make_docs(texts)
    sf = write_tables(documents=docs)
    got = {x.doc_id: x for x in queries.op8_simhash(spark, sf).collect()}
    fps = [brute_fp(t) for t in texts]
    want = brute_groups(list(range(len(texts))), fps)
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == want
    assert len(set(want)) < len(texts) - 10
    more = docs.selectExpr("*", "1 AS fp", "2 AS component_id")
    kept = sh.keep_first(more.unionByName(more.where("doc_id = 3")))
    assert kept.columns == more.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(want))


def test_null_ids_and_empty_table(spark, make_docs):
    docs = make_docs(["a b c d", "a b c d", "x"]).selectExpr(
        "if(doc_id = 2, 2, null) AS doc_id", "text", "lang", "source", "n_chars")
    assert sorted(str(x.component_id) for x in sh.groups(docs).collect()) == ["2", "None", "None"]
    assert sh.keep_first(docs).count() == 3
    assert sh.groups(make_docs([])).count() == 0


def test_the_row_decides_not_its_id(spark):
    r = random.Random(5)
    x, y, z, v = (" ".join(r.choices([f"w{i}" for i in range(500)], k=300)) for _ in range(4))
    assert len(set(brute_groups([1, 2, 3, 4], [brute_fp(t) for t in (x, y, z, v)]))) == 4
    many = [(9, " ".join(r.choices([f"v{i}" for i in range(500)], k=300))) for _ in range(20)]
    rows = [(3, x), (7, x), (7, y), (7, z), (None, v), (5, v), (None, v), (7, z), (7, x),
            *many, (8, None), (8, ""), (None, "p q r s"), (None, "p q r s")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, _id string")
    kept = sorted(((d.doc_id, d.text or "") for d in sh.keep_first(docs).collect()), key=str)
    want = [(3, x), (7, y), (7, z), (5, v), *many, (8, ""), *[(None, "p q r s")] * 2]
    assert kept == sorted(want, key=str)
