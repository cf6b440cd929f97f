from itertools import permutations

import pytest

from quarry.llm import filteraudit, queries


def fails(text, doc, docs):
    t = text or ""
    words = [w for w in __import__("re").split("[ \t-\r]+", t) if w]
    return [len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t),
            doc is not None and any(d is not None and d < doc and (x or "") == t for d, x in docs)]


def brute(docs, langs, good, toxic):
    told = [(lang or "", fails(t, d, docs), d) for (d, t), lang in zip(docs, langs)]
    out = {}
    for part in {p for p, _, _ in told}:
        rows = [(f, d) for p, f, d in told if p == part]
        worth = dict.fromkeys("ABCDE", 0)
        for order in permutations(range(5)):
            left = rows
            for step, i in enumerate(order, 1):
                gone = [r for r in left if r[0][i]]
                before = len([r for r in rows if r[0][i]]) - len(gone)
                left = [r for r in left if not r[0][i]]
                worth["ABCDE"[i]] += len(gone)
                out[part, "".join("ABCDE"[j] for j in order), step] = [
                    len(left), len(gone), before, len([r for r in rows if r[0][i] and sum(r[0]) == 1]),
                    len([r for r in gone if r[1] in good]), len([r for r in gone if r[1] in toxic]), "ABCDE"[i]]
        for key, v in out.items():
            if key[0] == part:
                v[-1] = worth[v[-1]] if isinstance(v[-1], str) else v[-1]
    return out


def audit(spark, write_tables, docs, langs, labels):
    rows = [(d, t, lang, "s", 1, "x") for (d, t), lang in zip(docs, langs)]
    sf = write_tables(
        documents=spark.createDataFrame(rows, "doc_id long, text string, lang string, mask string, n long, part string"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {}
    for r in queries.op12_filter_audit(spark, sf).collect():
        assert (r.part, r.filter_order, r.step) not in got
        got[r.part, r.filter_order, r.step] = [r.kept, r.removed, r.redundant, r.unique_fails,
                                               r.good_lost, r.toxic_lost, r.shapley]
    return got


def test_every_order_against_brute_force(spark, write_tables):
    long = " ".join(f"word{i}" for i in range(120))
    docs = [(0, long), (1, long), (1, long), (2, long + " #"), (3, "SHORT TEXT"), (4, "the " * 150), (5, None), (6, ""),
            (7, "x " * 200_000 + "&"), (8, long.upper()), (None, long), (None, None), (9, long + " a"),
            (10, "é" * 10 + "A"), (10, "SHORT TEXT"), (11, "SHORT TEXT")] + [(12, "copy")] * 30
    langs = ["en", "en", "de", None, "", "en", "de", None] + ["en"] * (len(docs) - 8)
    labels = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (3, 1, 0), (4, 0, 1), (5, None, None), (11, 1, 1), (None, 1, 1), (12, 1, 0)]
    good, toxic = {0, 1, 3, 11, 12}, {1, 4, 11}
    assert audit(spark, write_tables, docs, langs, labels) == brute(docs, langs, good, toxic)


def test_empty_table(spark, write_tables):
    assert audit(spark, write_tables, [], [], []) == {}


def test_lattice_counts_orders():
    edges = filteraudit.lattice(4)
    for s, i, orders in edges:
        assert orders == sum(1 for o in permutations(range(4))
                             if o.index(i) == bin(s).count("1") and set(o[:o.index(i)]) == {
                                 j for j in range(4) if s >> j & 1})


def test_too_many_filters(spark):
    counts = spark.createDataFrame([("", 0, 1, 0, 0)], "part string, mask int, n long, good long, toxic long")
    with pytest.raises(ValueError):
        filteraudit.audit(counts, "ABCDEFG")
    assert filteraudit.audit(counts, "A").collect()[0].kept == 1
