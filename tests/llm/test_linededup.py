import hashlib
import random

import pytest

from quarry.llm import linededup as ld
from quarry.llm import queries


def edits(a, b):
    """Levenshtein distance over words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(texts):
    """(doc, line) to near, of all lines that go."""
    lines = [(d, n, x) for d, t in enumerate(texts) for n, x in enumerate((t or "").split("\n"))
             if x.rstrip(" \t\r")]
    gone, first = {}, {}
    for d, n, x in lines:
        if x in first:
            gone[d, n] = False
        else:
            first[x] = (d, n)
    seen = list(first.items())
    for i, (x, at) in enumerate(seen):
        w = x.split(" ")
        for y, _ in seen[:i]:
            v = y.split(" ")
            if abs(len(v) - len(w)) <= 1 and max(len(v), len(w)) >= ld.MIN_WORDS and edits(v, w) <= 1:
                gone[at] = True
                break
    return gone


def cases(seed):
    r = random.Random(seed)
    vocab = ["a", "b", "c", "", "Dé", "e."]
    base = [[r.choice(vocab) for _ in range(r.choice([1, 3, 4, 5, 6, 7, 8, 9, 15, 16, 17, 32, 33]))]
            for _ in range(25)]

    def line():
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            at, what = r.randrange(len(w) + 1), r.randrange(3)
            if what == 0:
                w.insert(at, r.choice(vocab))
            elif w:
                w[min(at, len(w) - 1):min(at, len(w) - 1) + 1] = [] if what == 1 else [r.choice(vocab)]
        return " ".join(w)

    texts = [None, "", "\n", " \t\n\n ", "same line of words here\nsame line of words here"]
    texts += ["\n".join(line() for _ in range(r.randrange(1, 8))) for _ in range(40)]
    long = " ".join(r.choices(vocab, k=3_000))
    return texts + [long, long + " more", "x\n" * 3_000]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("broadcast", [True, False])
def test_lines_equal_brute_force(spark, make_docs, seed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(ld, "bounded", lambda df: df)
    texts = cases(seed)
    want = brute(texts)
    docs = make_docs(texts).selectExpr("*", "1 AS gone", "2 AS _gone", "3 AS line", "4 AS dk")
    got = {(r.doc_id, r.no): r.near for r in ld.repeated_lines(docs).collect()}
    assert got == want and any(want.values())
    kept = ld.dedup_lines(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    for d, t in enumerate(texts):
        lines = (t or "").split("\n")
        stay = [x for n, x in enumerate(lines) if (d, n) not in want]
        if t is None or len(stay) == len(lines):
            assert rows[d].text == t
        elif any(x.strip(" \t\r") for x in stay):
            assert rows[d].text == "\n".join(stay) and rows[d].n_chars == len(rows[d].text)
        else:
            assert d not in rows


def test_variant_keys_meet_where_sequences_do(spark):
    lines = ["a b c d e", "a b c d e f", "a x c d e", "b c d e f", "a b", "a"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    rows = df.select("line", ld.F.explode(ld._variants(ld._words(ld.F.col("line")))).alias("v")).collect()
    by = {}
    for r in rows:
        w = r.line.split(" ")
        seq = tuple(w if r.v.pos < 0 else w[:r.v.pos] + w[r.v.pos + 1:])
        by.setdefault(r.v.key, set()).add(seq)
    assert all(len(s) == 1 for s in by.values())
    assert len(by) == len({x for s in by.values() for x in s})
    assert sum(r.line == "a b" for r in rows) == 1 and sum(r.line == "a b c d e" for r in rows) == 6


def test_query_on_tables(spark, make_docs, write_tables):
    texts = cases(3)
    want = brute(texts)
    sf = write_tables(documents=make_docs(texts))
    for r in queries.op9_line_dedup(spark, sf).collect():
        mine = sorted(n for d, n in want if d == r.doc_id)
        lines = (texts[r.doc_id] or "").split("\n")
        assert r.gone == ",".join(map(str, mine))
        assert r.n_near == sum(want[r.doc_id, n] for n in mine) and r.n_exact == len(mine) - r.n_near
        assert r.n_lines == (0 if texts[r.doc_id] is None else len(lines))
        kept = "\n".join(x for n, x in enumerate(lines) if n not in mine)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_repeated_rows_null_ids_and_empty_table(spark, make_docs):
    docs = make_docs(["one\ntwo", "two\nthree", "one\ntwo"])
    twice = docs.where("doc_id = 0").unionByName(docs)
    assert sorted(r.text for r in ld.dedup_lines(twice).collect()) == ["one\ntwo", "one\ntwo", "three"]
    nulls = docs.selectExpr("if(doc_id = 1, null, doc_id) AS doc_id", "text")
    assert sorted(r.text for r in ld.dedup_lines(nulls).collect()) == ["one", "two\nthree"]
    assert ld.dedup_lines(make_docs([])).count() == 0
