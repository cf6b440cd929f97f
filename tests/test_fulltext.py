"""Text vectors, web-style queries, match and ts_rank."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft


def show(n):
    if n is None:
        return None
    if n.op == "lex":
        return n.lexeme
    return (n.op, [show(k) for k in n.kids])


@pytest.mark.parametrize("q,want", [
    ("a b", ("and", ["a", "b"])),
    ("a b or c", ("or", [("and", ["a", "b"]), "c"])),
    ('"a b" -c', ("and", [("phrase", ["a", "b"]), ("not", ["c"])])),
    ("or a", "a"),
    ("a or", "a"),
    ("-", None),
    ("", None),
    ("Ação!", "ação"),
    ("x-y", ("phrase", ["x", "y"])),          # a word of several parts is their phrase
    ("pg_class -a/b", ("and", [("phrase", ["pg", "class"]), ("not", [("phrase", ["a", "b"])])])),
])
def test_websearch_parse(q, want):
    assert show(ft.websearch_query(q).tree) == want


def test_text_query_choice():
    assert ft.text_query(None) is None
    assert show(ft.text_query('"of the"').tree) == ("phrase", ["of", "the"])
    assert show(ft.text_query('"a b" or "c d"').tree) == ("phrase", ["a", "b", "or", "c", "d"])
    assert show(ft.text_query("of the").tree) == ("and", ["of", "the"])


def test_like_pattern():
    assert ft.like_pattern("a%b") == "%a%b%"
    assert ft.like_pattern(r"a\%b") == r"%a\%b%"
    assert ft.like_pattern(r"a\xb") == "%axb%"
    with pytest.raises(ValueError):
        ft.like_pattern("a\\")


def D(g):
    return ft.word_distance_py(g)


def brute_rank(pos_a, pos_b=None):
    """ts_rank from the formulas: AND of two lexemes, or one lexeme."""
    if pos_b is None:
        s = sum(1.0 / (j + 1) ** 2 for j in range(len(pos_a)))
        return s / ft.ZETA2
    prod, n = 1.0, 0
    for p in pos_a:
        for q in pos_b:
            if p != q:
                prod *= 1 - math.sqrt(D(abs(p - q)))
                n += 1
    return 1 - prod if n else 1e-20


def rank_of(spark, text, query):
    df = spark.createDataFrame([(text,)], "t string")
    mr = ft.match_rank(ft.websearch_query(query), ft.text_vector(F.col("t")))
    r = df.select(mr.alias("m")).first()[0]
    return r["match"], r["rank"]


def test_rank_and(spark):
    m, r = rank_of(spark, "a b x a y b", "a b")
    assert m and r == pytest.approx(brute_rank([1, 4], [2, 6]), rel=1e-12)


def test_rank_single(spark):
    m, r = rank_of(spark, "a z a z a", "a")
    assert m and r == pytest.approx(brute_rank([1, 3, 5]), rel=1e-12)


def test_rank_or_divides_by_query_lexemes(spark):
    m, r = rank_of(spark, "a z a", "a or q")
    assert m and r == pytest.approx(brute_rank([1, 3]) / 2, rel=1e-12)


def test_not_gives_tiny_rank(spark):
    m, r = rank_of(spark, "x a", "x -y")
    assert m and r == pytest.approx(1e-20)


def test_phrase(spark):
    df = spark.createDataFrame([("of the cat",), ("the of cat",)], "t string")
    mr = ft.match_rank(ft.phrase_query("of the"), ft.text_vector(F.col("t")))
    got = [r[0] for r in df.select(mr.match).collect()]
    assert got == [True, False]


def test_metadata_weight_and_shift(spark):
    df = spark.createDataFrame([("a b", '{"k": "a"}')], "c string, m string")
    tsv = df.select(ft.text_vector(F.col("c"), F.col("m")).alias("v")).first()[0]
    assert [(e.lexeme, e.pos, e.weight) for e in tsv] == [
        ("a", 1, "A"), ("b", 2, "A"), ("k", 3, "B"), ("a", 4, "B")]


def test_position_limits_are_off_unless_asked_for(spark):
    text = " ".join(["w"] * 20_000)
    df = spark.createDataFrame([(text,)], "t string")
    tsv = ft.text_vector(F.col("t"))
    e = df.select(ft.lexeme_entries(tsv, "w").alias("e")).first()[0]
    assert len(e) == 20_000 and e[-1].pos == 20_000
    e = df.select(ft.limit_entries(tsv, 256).alias("e")).first()[0]
    assert len(e) == 256 and e[-1].pos == 256
    last = df.select(F.element_at(ft.text_vector(F.col("t"), max_pos=100), -1).pos.alias("p")).first()[0]
    assert last == 100


def test_lexical_score_cases(spark):
    df = spark.createDataFrame([("the cat at home",)], "c string")
    tsv = ft.text_vector(F.col("c"))
    for q, want in [(None, 0.0), ("", 1.0), ("zzz", 0.0), ("cat at", None), ("t a", 1.0)]:
        got = df.select(ft.lexical_score(q, tsv, F.col("c"))).first()[0]
        if want is None:
            assert 0 < got < 1
        else:
            assert got == want, q


def test_text_vector_splits_a_text_once(spark):
    """The metadata's positions do not split the content again for each word."""
    import time
    df = spark.createDataFrame([("word " * 200_000, "m " * 2_000)], "c string, m string")
    start = time.time()
    row = df.select(ft.text_vector(F.col("c"), F.col("m")).alias("v")).select(
        F.size("v").alias("n"), F.element_at("v", -1).alias("last")).first()
    assert (row.n, row.last.pos, row.last.weight) == (202_000, 202_000, "B")
    assert time.time() - start < 20
