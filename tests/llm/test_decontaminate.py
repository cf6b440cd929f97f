import hashlib
import random
import re

from quarry.llm import decontaminate as dc
from quarry.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(texts, items, n=10):
    """Per text: words, hit places, items, from the definition."""
    wins = {}
    for item, t in items:
        w = WORD.findall(lower(t))
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[i:i + k]), set()).add("null" if item is None else str(item))
    out = []
    for t in texts:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    found |= wins[tuple(w[i:i + k])]
        out.append((len(w), hit, sorted(found)))
    return out


def cases():
    r = random.Random(4)
    vocab = ["the", "a", "of", "Été", "x1", "über", "straße", "Q"]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([1, 3, 9, 10, 11, 25])))) for i in range(2, 12)]
    items += [(20, None), (21, ""), (22, "--- !!"), (None, "null Item of exactly one two three four five"),
              (2, "a second text of item two")]
    texts = [None, "", "... !", "no hit here at all ever"]
    for i in range(60):
        parts = [" ".join(r.choices(vocab, k=r.randrange(12)))]
        parts.append((r.choice(items)[1] or "").upper() if r.random() < 0.5 else "")
        parts.append("; ".join(r.choices(vocab, k=r.randrange(12))))
        texts.append("\n".join(parts))
    texts += [texts[10]] * 3 + ["word " * 50_000 + (items[3][1] or "")]
    return texts, items


def test_contamination_equals_brute_force(spark, make_docs):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    for bound in (dc.MAX_BROADCAST_BYTES, 300):  # one block, and many
        got = {r.doc_id: r for r in dc.contamination(make_docs(texts), bench,
                                                     max_broadcast_bytes=bound).collect()}
        assert len(got) == len(texts)
        for i, (n, hit, found) in enumerate(want):
            places = {p for a, b in zip(got[i].runs[::2], got[i].runs[1::2]) for p in range(a, b)}
            assert (got[i].n_words, got[i].n_hit, places, got[i]["items"]) == (n, len(hit), hit, found)


def test_removal_of_documents_and_spans(spark, make_docs):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    docs = make_docs(texts).selectExpr("*", "'x' AS _runs", "1 AS n_words")  # clashing names
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, w in enumerate(want) if not w[1]}
    cut = {r.doc_id: r.text for r in dc.decontaminate(docs, bench, remove="spans").collect()}
    for i, (_, hit, _) in enumerate(want):
        if hit:
            words = WORD.findall(lower(texts[i]))
            assert WORD.findall(lower(cut[i])) == [w for k, w in enumerate(words) if k not in hit]
        else:
            assert cut[i] == texts[i]


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in dc.contamination(make_docs(["a b", None]), bench).collect()] == [0, 0]
    assert dc.contamination(make_docs([]), bench).count() == 0


def test_query_on_tables(spark, make_docs, write_tables):
    items = [(i, "one two three four five six seven eight nine ten " + "x" * i) for i in (9, 10)]
    sf = write_tables(documents=make_docs(["ONE two three four five six seven eight nine ten"]),
                      benchmark=spark.createDataFrame(items, "item_id long, text string"))
    row = queries.op1_decontaminate(spark, sf).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (10, 10, 2, True)
    assert row.items_sha256 == hashlib.sha256(b"10,9").hexdigest()
