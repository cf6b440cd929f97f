"""Greedy packing and token windows (T6-T10), with property tests."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import chunking as ch

TOK = re.compile(r"[^\W_]+|[^\w\s]|_", re.U)


def ntok(p):
    return len(TOK.findall(p))


def windows(p, size, overlap):
    toks = [m for m in re.finditer(r"(?:[^\W_]+|[^\w\s]|_)\s*", p, re.U)]
    n, step, out, s = len(toks), size - overlap, [], 0
    while s < n:
        out.append("".join(m.group(0) for m in toks[s:s + size]).rstrip())
        if s + size >= n:
            break
        s += step
    return out


def brute_pack(paras, m, ratio):
    out, cur, cnt = [], [], 0
    for p in paras:
        n = ntok(p)
        if n > m:
            if cur:
                out.append("\n\n".join(cur))
                cur, cnt = [], 0
            out.extend(windows(p, m, int(m * ratio)))
            continue
        if cnt + n <= m:
            cur.append(p)
            cnt += n
        else:
            out.append("\n\n".join(cur))
            cur, cnt = [p], n
    if cur:
        out.append("\n\n".join(cur))
    return out


def pack(spark, paras, m, ratio=0.25):
    df = spark.createDataFrame([(paras,)], "p array<string>")
    return df.select(ch.pack_chunks(F.col("p"), m, ratio)).first()[0]


def w(n, word="ab"):
    return " ".join([word] * n)


def test_edge_cases(spark):
    cases = {
        "exact fit": [w(4), w(6)],
        "one over": [w(4), w(7)],
        "long first": [w(25), w(3), w(3)],
        "long middle": [w(3), w(25), w(3)],
        "long last": [w(3), w(3), w(25)],
        "empty": [],
    }
    for name, paras in cases.items():
        assert pack(spark, paras, 10) == brute_pack(paras, 10, 0.25), name
    assert pack(spark, [w(4), w(6)], 10) == [w(4) + "\n\n" + w(6)]
    assert pack(spark, [], 10) == []


def test_windows_overlap_and_cover(spark):
    p = " ".join(f"w{i}" for i in range(23))
    got = spark.createDataFrame([(p,)], "p string").select(ch.token_windows(F.col("p"), 10, 3)).first()[0]
    assert got == windows(p, 10, 3)
    assert got[0].split()[0] == "w0" and got[-1].split()[-1] == "w22"
    assert got[1].split()[0] == "w7"  # step 7


para = st.lists(st.sampled_from(["aa", "b", "ccc", ",", "dd."]), min_size=1, max_size=30).map(" ".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(para, max_size=12), st.integers(min_value=3, max_value=20))
def test_pack_properties(spark, paras, m):
    got = pack(spark, paras, m)
    assert got == brute_pack(paras, m, 0.25)
    groups = [c for c in got if "\n\n" in c]
    assert all(sum(ntok(x) for x in c.split("\n\n")) <= m for c in groups)
    n_groups = sum(1 for c in got if ntok(c) <= m)
    assert n_groups >= (1 if any(ntok(p) <= m for p in paras) else 0)


def test_chunk_rows_numbered(spark):
    text = "\n\n".join(["long paragraph " * 10, "tail paragraph that is long enough to survive"])
    df = spark.createDataFrame([(7, text)], "doc_id int, text string")
    rows = ch.hierarchical_chunks(df, "text", ["doc_id"], max_tokens=8).collect()
    assert [r.chunk_index for r in rows] == list(range(len(rows)))


def test_token_count_default(spark):
    r = spark.createDataFrame([("Héllo, wörld_x 12!",)], "p string").select(
        tx.regex_token_count(F.col("p"))).first()[0]
    assert r == 7  # Héllo , wörld _ x 12 !


def test_char_windows(spark):
    t = "abcdefghij" * 5
    got = spark.createDataFrame([(t,)], "t string").select(ch.char_windows(F.col("t"), 20, 5)).first()[0]
    assert got[0] == t[:20] and got[1] == t[15:35] and got[-1].endswith(t[-1])


def test_token_limit():
    from types import SimpleNamespace as NS
    assert ch.token_limit(NS(max_seq_length=384)) == 384
    assert ch.token_limit(NS(max_seq_length=None, tokenizer=NS(model_max_length=512))) == 512
    assert ch.token_limit(None, NS(model_max_length=128)) == 128
    assert ch.token_limit(NS()) == ch.config.MAX_TOKENS


def test_tokenizer_hook_packs_in_its_own_tokens(spark):
    """Characters as tokens: packing, windows and limits follow the plug-in."""
    def load():
        return lambda text: [(i, i + 1) for i in range(len(text)) if not text[i].isspace()]
    df = spark.createDataFrame([(1, ["abcd", "efg", "hij", "k"]), (2, ["ab cdefghijkl mnop", "q"]), (3, []),
                                (4, None)], "k int, p array<string>")
    chunk = ch.tokenizer_chunks(load, max_tokens=8, overlap_ratio=0.25, joiner="|")
    got = {r.k: r.c for r in df.select("k", chunk(F.col("p")).alias("c")).collect()}
    assert got == {1: ["abcd|efg", "hij|k"], 2: ["ab cdefgh", "ghijkl mn", "mnop", "q"], 3: [], 4: None}
    text = spark.createDataFrame([("a long paragraph of text " * 30,)], "text string")
    rows = ch.hierarchical_chunks(text, "text", [], chunker=ch.tokenizer_chunks(load, 64)).collect()
    assert len(rows) > 5 and all(sum(not c.isspace() for c in r.content) <= 64 for r in rows)


def test_a_hundred_thousand_paragraphs(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: i % 7 + 1).alias("n"))
    got = df.select(ch.group_ids(F.col("n"), 20).alias("g")).first().g
    want, g, cur = [], -1, 0
    for i in range(1, 100_001):
        n = i % 7 + 1
        if g < 0 or cur + n > 20:
            g, cur = g + 1, 0
        cur += n
        want.append(g)
    assert got == want
