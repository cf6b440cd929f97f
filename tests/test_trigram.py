"""Trigram similarity and the fuzzy join (L12) against a brute force."""

from quarry.functions import trigram as tg

NAMES = [(1, "small ring"), (2, "smallish rings"), (3, "blue bolt"), (4, ""), (5, None),
         (6, "a a a a"), (7, "ring small")] + [(100 + i, "hot hot name") for i in range(30)]
TERMS = ["SMALL", "ring", "bolts", "hot", "", None, "zzz"]


def brute(threshold):
    out = set()
    for k, name in NAMES:
        a = set(tg.py_grams(name or ""))
        for t in {t for t in TERMS if t is not None}:
            b = set(tg.py_grams(t))
            u = len(a | b)
            sim = 0.0 if u == 0 else len(a & b) / u
            if sim >= threshold:
                out.add((k, t, round(sim, 9)))
    return out


def test_fuzzy_join_brute_force(spark):
    t = spark.createDataFrame(NAMES, "k long, name string")
    lk = spark.createDataFrame([(x,) for x in TERMS], "term string")
    for th in (0.08, 0.3, 0.6):
        got = {(r.k, r.term, round(r.sim, 9)) for r in tg.fuzzy_join(t, "k", "name", lk, "term", th).collect()}
        assert got == brute(th)
