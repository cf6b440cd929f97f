import hashlib
import random
import re

from quarry.llm import pii, queries


def luhn(v):
    d = [int(c) for c in v if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= sum(c.isdigit() for c in v) <= 19 and luhn(v)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= sum(c.isdigit() for c in v) <= 15)]


def base(text):
    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m.group())]
            for k, p, ok in KINDS]


def cases():
    r = random.Random(6)
    signs = "aZ0123456789@..+-- ()_%é😀\n"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(3_000)]
    return texts + [
        None, "", "4111 1111 1111 1111, 4111-1111-1111-1112", "a@b.c+d@e.f@g.h", "+x@y.z", "9" * 20_000,
        "a" * 30_000, "a@" * 9_000, "1 " * 9_000, "+1(" * 5_000, "1.2.3.4.5.6.7.8 256.1.1.1 001.0.0.255",
        "😀 +49 (30) 123-456 7 x", "x" * 50_000 + " me@example.org " + "y" * 50_000]


def test_base_spans_equal_the_definition(spark, make_docs, write_tables):
    texts = cases()
    sf = write_tables(documents=make_docs(texts))
    rows = queries.op7_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(w) for w in want], texts[r.doc_id][:99]
        joined = ",".join(sum(want, []))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_context_finds_unseen_identifiers(spark, make_docs):
    known = [f"Please reach support at user{i}@mail.example.org for help" for i in range(8)]
    unseen = "Please reach support at user77(at)mail1234 for help"
    clean = ["He counted to 123456 for hours", "See order 2024-000123 there", "nothing at all"]
    docs = make_docs([*known, unseen, *clean, unseen])
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    at = unseen.index("user77")
    want = (0, at, at + len("user77(at)mail1234"))
    for i in (8, 12):
        assert [tuple(s) for s in got[i].spans] == [want] and got[i].base == []
    assert all(got[i].spans == [] for i in (9, 10, 11))
    assert all(got[i].spans == got[i].base != [] for i in range(8))
    # two seeds are not enough
    few = pii.find(make_docs([*known[:2], unseen])).collect()
    assert all(r.spans == r.base for r in few)


def test_unseen_values_do_not_silence_a_context(spark, make_docs):
    seeds = [f"ring our clerk at desk{i}@mail.example.org until noon" for i in range(3)]
    unseen = [f"ring our clerk at desk{i}(at)mail1234 until noon" for i in range(12)]
    mixed = [t for i in range(3) for t in (f"now write to x{i}@example.org please",
                                           f"now write to 10.0.0.{i} please")]
    doubtful = [f"now write to 9988776{i} please" for i in range(9)]
    docs = make_docs([*seeds, *unseen, *mixed, *doubtful])
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    at = unseen[0].index("desk")
    for i, t in enumerate(unseen, 3):
        assert [tuple(s) for s in got[i].spans] == [(0, at, t.index(" until"))]
    assert all(got[i].spans == [] for i in range(21, 30))


def test_candidates_of_digit_groups_and_in_unspaced_text(spark, make_docs):
    spaced = [f"my new tel: +49 30 55512{i:02} at work" for i in range(4)]
    groups = ["030 123 4567", "0171 2345678", "030) 123-45.67", "0171 2345679 (old)"]
    groups = [f"my new tel: {g} at work" for g in groups]
    groups.append("my new tel: 030 123 4567 2nd floor")
    pad = "x" * 150
    packed = [f'{{"pad":"{pad}","mail":"u{i}@example.org","city":"B"}}' for i in range(4)]
    hidden = f'{{"pad":"{pad}","mail":"u77%40mail1234","city":"B"}}'
    docs = make_docs([*spaced, *groups, *packed, hidden])
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(docs).collect()}
    phone = pii.KINDS.index("phone")
    for i, (t, v) in enumerate(zip(groups, ["030 123 4567", "0171 2345678", "030) 123-45.67", "0171 2345679",
                                            "030 123 4567"]), 4):
        assert (phone, t.index(v), t.index(v) + len(v)) in got[i], t
    at = hidden.index("u77")
    assert got[13] == [(0, at, at + len("u77%40mail1234"))]


def test_redaction(spark, make_docs):
    texts = ["mail a@b.org or +1 (017) 555-7713.", None, "", "é 10.0.0.1", "none"]
    docs = make_docs(texts).selectExpr("*", "1 AS spans", "2 AS _spans", "3 AS kind")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == [
        "mail <email> or <phone>.", None, "", "é <ip>", "none"]


def test_repeated_rows_and_empty_table(spark, make_docs):
    docs = make_docs(["x@y.zz"])
    assert [len(r.spans) for r in pii.find(docs.unionByName(docs)).collect()] == [1, 1]
    assert pii.find(make_docs([])).count() == 0


def test_work_grows_with_the_number_of_identifiers(spark, make_docs):
    import time

    def took(n):
        text = " ".join(f"on 10.{i % 250}.{i // 250 % 250}.7 or mail u{i}@mail{i % 7}.org" for i in range(n // 2))
        start = time.time()
        row = pii.find(make_docs([text])).collect()[0]
        assert len(row.base) == 2 * (n // 2)
        return time.time() - start

    took(100)
    few, many = took(10_000), took(40_000)
    assert many < 60 and many < 8 * max(few, 3)


def around(text, start, end):
    """The lexical patterns of a span, from the definition."""
    words = lambda part: [w for w in re.split(r'[\s"{}\[\]<>&?=|,;]+', part.lower()) if w]
    b, a = words(text[max(0, start - pii.REACH):start]), words(text[end:end + pii.REACH])
    out = []
    if len(b) > 1:
        out.append(f"{b[-2]} {b[-1]} _")
    if b and a:
        out.append(f"{b[-1]} _ {a[0]}")
    return out


def graph(marks):
    """Confident patterns by the definition; ``marks``: (patterns, value, kind)."""
    edges = {}
    for patterns, value, kind in marks:
        for p in patterns:
            edges[p, value] = max(kind, edges.get((p, value), -1))
    seeds = {}
    for (_, v), kind in edges.items():
        if kind >= 0:
            seeds[v] = max(kind, seeds.get(v, -1))
    held = {}
    for p, v in edges:
        if v in seeds:
            held.setdefault(p, {}).setdefault(seeds[v], set()).add(v)
    speak = {(p, k): sum(map(len, by.values())) for p, by in held.items() for k, vs in by.items()
             if len(vs) >= pii.SUPPORT}
    score = {v: {k: (1.0, 0.0)} for v, k in seeds.items()}
    for _ in range(pii.ROUNDS):
        conf = {}
        for (p, k), n in speak.items():
            got = [score[v][k] for q, v in edges if q == p and k in score.get(v, {})]
            conf[p, k] = sum(s for s, _ in got) / (n + 1 + sum(w for _, w in got))
        score = {v: {k: (1.0, 0.0)} for v, k in seeds.items()}
        for p, v in edges:
            if v not in seeds:
                for (q, k), c in conf.items():
                    if q == p:
                        old = score.setdefault(v, {}).get(k, (0, 0))[0]
                        score[v][k] = (max(old, c * pii.DAMPING), pii.DAMPING)
    return {pk: c for pk, c in conf.items() if c >= pii.CONFIDENT}


def test_pattern_graph_against_brute_force(spark, make_docs):
    r = random.Random(8)
    verbs = ["call", "write", "ping", "pay"]
    texts = []
    for i in range(300):
        verb, name = r.choice(verbs), r.choice(["anna", "bob", "our clerk"])
        what = {"call": f"+49 30 {r.randrange(10**6, 10**7)}", "write": f"u{r.randrange(60)}@mail.org",
                "ping": f"10.0.{r.randrange(9)}.{r.randrange(99)}", "pay": "4111 1111 1111 1111"}
        kind = verb if r.random() < 0.97 else r.choice(verbs)
        value = what[kind] if r.random() < 0.6 else f"id{r.randrange(10**4, 10**5)}x{r.randrange(9)}"
        texts.append(f"then {name} {verb} on {value} {r.choice(['today', 'soon', 'x'])}")
    found = pii.scan(make_docs(texts)).collect()
    marks = [(m.around, m.value.lower(), m.kind) for row in found for m in row.marks]
    for row in found:
        for m in row.marks:
            assert m.around == around(texts[row.doc_id], m.start, m.end)
            assert texts[row.doc_id][m.start:m.end] == m.value
            free = all(m.end <= o.start or o.end <= m.start for o in row.marks if o.kind >= 0 and o is not m)
            assert m.kind >= 0 or free
    patterns = graph(marks)
    assert patterns and any(k >= 0 for _, k in patterns)
    want = set()
    for row in found:
        for m in row.marks:
            told = [(c, -k) for p in m.around for (q, k), c in patterns.items() if q == p]
            if m.kind < 0 and told:
                want.add((row.doc_id, -max(told)[1], m.start, m.end))
    got = {(x.doc_id, x.kind, x.start, x.end) for x in pii.discover(pii.scan(make_docs(texts))).collect()}
    assert got == want and len(want) > 10


def test_tokens_of_any_length_are_searched_alike(spark, make_docs):
    def text(pad, value):
        return f'see "{"x" * pad}","mail":"{value}","city":"B" now'

    known = [text(pad, f"u{i}@example.org") for i, pad in enumerate((5, 60, 70, 300))]
    hidden = [text(pad, "u77%40mail1234") for pad in (5, 60, 63, 64, 65, 66, 300)]  # tokens around 100 characters
    got = {r.doc_id: r for r in pii.find(make_docs([*known, *hidden])).collect()}
    for i, t in enumerate(hidden, 4):
        at = t.index("u77")
        assert (0, at, at + len("u77%40mail1234")) in [tuple(s) for s in got[i].spans], t
