"""Token classes (L1) and dictionaries by class (L2)."""

import time

from pyspark.sql import functions as F

from quarry.functions import tokens as tk

CASES = {
    "Word ação Straße x1 42": [("asciiword", "Word"), ("word", "ação"), ("word", "Straße"), ("numword", "x1"), ("uint", "42")],
    "write a.b-c@mail.example.org now": [("asciiword", "write"), ("email", "a.b-c@mail.example.org"), ("asciiword", "now")],
    "http://www.example.com/a/b?x=1 end": [
        ("protocol", "http://"), ("url", "www.example.com/a/b?x=1"), ("host", "www.example.com"), ("url_path", "/a/b?x=1"),
        ("asciiword", "end")],
    "see example.com.": [("asciiword", "see"), ("host", "example.com")],
    "v 1.2.3 and 1.5 -2.5": [("asciiword", "v"), ("version", "1.2.3"), ("asciiword", "and"), ("float", "1.5"), ("float", "-2.5")],
    "well-known pós-guerra mid-80s": [
        ("asciihword", "well-known"), ("hword_asciipart", "well"), ("hword_asciipart", "known"),
        ("hword", "pós-guerra"), ("hword_part", "pós"), ("hword_asciipart", "guerra"),
        ("numhword", "mid-80s"), ("hword_asciipart", "mid"), ("hword_numpart", "80s")],
    "-- ... @ / a- -b": [("asciiword", "a"), ("asciiword", "b")],
    "日本 é": [("word", "日本"), ("word", "é")],
    "": [], None: [],
}


def test_every_class(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, t string")
    got = {r.i: [(x["class"], x["token"]) for x in r.s] for r in df.select("i", tk.scan(F.col("t")).alias("s")).collect()}
    for i, text in enumerate(CASES):
        assert got[i] == CASES[text], text


def test_long_texts_are_linear(spark):
    start = time.time()
    texts = ["a" * 300_000, "a-" * 100_000, "a." * 100_000, "1." * 100_000, "a@" * 100_000, "http://" * 30_000,
             "a.b-c@d-e.f" * 20_000, "word " * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select(F.size(tk.scan(F.col("t"))).alias("n")).agg(F.min("n")).first()[0] >= 1
    assert time.time() - start < 120


def test_dictionary_chain_and_lexemes(spark):
    rows = [(1, "Documentos da AÇÃO, documentos pós-guerra http://x.org/Abc"), (2, "documento " * 50), (3, None)]
    df = spark.createDataFrame(rows, "doc long, t string")
    words = {(r["class"], r.token): r.lexeme for r in tk.vocabulary(df, "t").collect()}
    assert words["asciiword", "Documentos"] == words["asciiword", "documentos"] == "document"
    assert words["word", "AÇÃO"] == "ação"        # stemming would cut it
    assert words["hword_part", "pós"] == "pós" and words["hword_asciipart", "guerra"] == "guerr"
    assert words["url", "x.org/Abc"] == "x.org/abc" and ("protocol", "http://") not in words
    got = sorted((r.doc, r.pos, r.lexeme) for r in tk.lexemes(df, "doc", "t").collect())
    assert [x for x in got if x[0] == 1] == [
        (1, 1, "document"), (1, 2, "da"), (1, 3, "ação"), (1, 4, "document"), (1, 5, "pós-guerra"), (1, 6, "pós"),
        (1, 7, "guerr"), (1, 8, "x.org/abc"), (1, 9, "x.org"), (1, 10, "/abc")]
    assert [x[1:] for x in got if x[0] == 2] == [(i, "document") for i in range(1, 51)]


def test_the_jvm_scan_finds_the_same_tokens(spark):
    """``SCAN_RE`` tries less at each place than ``TOKEN_RE`` and finds as much."""
    import random
    rng = random.Random(5)
    bits = ["ab", "Zé", "9", "12", ".", "-", "_", "+", "@", ":", "/", "://", " ", ",", "x.de", "a-b", "1.2", "é-9",
            "a" * 70, "http://", "@x.org", "a.b@c.de", "w.x.org/p?q=1", "1.2.3", "-4.5", "\n", "日本", "_a", "x" * 64 + "."]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randint(1, 14))),) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "t string")
    found = df.select("t", *(F.regexp_extract_all("t", F.lit(r), 0).alias(n)
                             for n, r in (("plain", tk.TOKEN_RE), ("quick", tk.SCAN_RE))))
    assert found.where("plain <> quick").limit(3).collect() == []
    words = spark.createDataFrame([("some plain words of a text and 12 numbers é " * 20_000,)], "t string")
    assert tk.SCAN_RE != tk.TOKEN_RE
    assert words.select(F.size(F.regexp_extract_all("t", F.lit(tk.SCAN_RE), 0))).first()[0] == 200_000


def test_vocabulary_of_a_long_text_of_distinct_tokens(spark):
    """Tokens are told apart as strings, not each compared with all others."""
    text = " ".join(f"w{i}x a{i}-b{i}" for i in range(30_000)) + " http://x.org/Abc x.org/Abc w1x"
    start = time.time()
    words = tk.vocabulary(spark.createDataFrame([(text,), (text,), (None,)], "t string"), "t")
    got = {r["class"]: r.n for r in words.groupBy("class").agg(F.count("*").alias("n")).collect()}
    assert got == {"numword": 30_000, "numhword": 30_000, "hword_numpart": 60_000, "url": 1, "host": 1, "url_path": 1}
    assert words.distinct().count() == words.count() and time.time() - start < 60
