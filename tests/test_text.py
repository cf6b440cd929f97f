"""Paragraph rules (T1-T5, T11) on the edge rows of FIXTURES §3."""

import re

from pyspark.sql import functions as F

from quarry.functions import text as tx

EDGE = [
    (1, "SUMÁRIO"),
    (2, "Índice geral do relatório anual com muitas palavras aqui"),
    (3, "Table of Contents for the whole book, which is long enough"),
    (4, "This sentence mentions the contents of a box and is long enough."),
    (5, "O conteúdo deste parágrafo é mantido porque não é sumário?"),
    (6, "1.2 Title text 15"),
    (7, "3 A 4"),
    (8, "1.2 Title text\nwith a break 15"),
    (9, "x" * 49),
    (10, "y" * 50),
    (11, "z" * 51),
    (12, "\t\xa0" + "w" * 60 + "\xa0\t"),
    (13, "nul\x00inside " + "v" * 50),
    (14, "12 " + "words " * 10 + "more 7"),
]


def brute_keep(p: str) -> bool:
    """The rules, written out in plain Python."""
    low = p.lower()
    if re.search(r"\b(sum[aá]rio|índice|table of contents|contents?)\b", low):
        return False
    if re.match(r"^\d+(?:\.\d+)*\s+.+\s+\d+$", p):
        return False
    return len(p) >= 50


def test_rules_match_plain_python(spark):
    df = spark.createDataFrame(EDGE, "id int, text string")
    got = {r.id: r.keep for r in df.select("id", tx.keep_paragraph(tx.ustrip(F.col("text"))).alias("keep")).collect()}
    want = {i: brute_keep(t.strip()) for i, t in EDGE}
    assert got == want
    assert got[5] is False  # contains "sumário" as a word
    assert got[4] is False  # "contents" inside a sentence is dropped
    assert got[10] and got[11] and not got[9]


def test_strip_is_python_strip(spark):
    s = "\t\xa0  abc 　\n\x1c"
    r = spark.createDataFrame([(s,)], "t string").select(tx.ustrip(F.col("t"))).first()[0]
    assert r == s.strip()


def test_split_keeps_order_and_drops_empty(spark):
    text = "a\n\n\n\nb \n\n  \n\nc"
    r = spark.createDataFrame([(text,)], "t string").select(tx.paragraphs(F.col("t"), "\n\n")).first()[0]
    assert r == [p.strip() for p in text.split("\n\n") if p.strip()]


def test_filter_paragraphs_order(spark):
    text = "\n\n".join(t for _, t in EDGE)
    r = spark.createDataFrame([(text,)], "t string").select(tx.filter_paragraphs(F.col("t"))).first()[0]
    paras = [p.strip() for p in text.split("\n\n") if p.strip()]
    assert r == [p for p in paras if brute_keep(p)]


def test_strip_nul(spark):
    r = spark.createDataFrame([("a\x00b\x00",)], "t string").select(tx.strip_nul(F.col("t"))).first()[0]
    assert r == "ab"
