"""The Portuguese stemmer: pairs of the published sample vocabulary, and its use
as a dictionary of text vectors and queries."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions.stemmer import portuguese

PAIRS = {
    "boa": "boa", "boainain": "boainain", "boas": "boas", "boataria": "boat", "boate": "boat",
    "boates": "boat", "boatos": "boat", "bob": "bob", "boba": "bob", "bobagem": "bobag",
    "bobagens": "bobagens", "bobalhões": "bobalhõ", "bobear": "bob", "bobeira": "bobeir",
    "bobinho": "bobinh", "bobo": "bob", "boca": "boc", "bocadas": "boc", "bocado": "boc",
    "bocas": "boc", "bode": "bod", "boemia": "boem", "quilométricas": "quilométr",
    "quilômetros": "quilômetr", "quilos": "quil", "química": "químic", "quimicamente": "quimic",
    "documento": "document", "documentos": "document"}


@pytest.mark.parametrize("word", PAIRS)
def test_published_pairs(word):
    assert portuguese(word) == PAIRS[word]


def test_edge_words():
    assert [portuguese(w) for w in ("", "a", "x1", "ab", "ç", "ã")] == ["", "a", "x1", "ab", "c", "ã"]


def test_dictionary_in_vectors_and_queries(spark):
    df = spark.createDataFrame([(1, "Os Documentos quilométricos"), (2, None), (3, "documento"), (4, "outro")],
                               "k int, t string")
    got = [r.w for r in df.select(ft.words(F.col("t"), "portuguese").alias("w")).collect()]
    assert got == [["os", "document", "quilométr"], [], ["document"], ["outr"]]
    tq = ft.websearch_query("documentos", "portuguese")
    mr = ft.match_rank(tq, ft.text_vector(F.col("t"), dictionary="portuguese"))
    assert sorted(r.k for r in df.select("k", mr.match.alias("m")).where("m").collect()) == [1, 3]
    one = df.select(F.explode(ft.words(F.col("t"))).alias("w")).select(
        ft.apply_dictionary(F.col("w"), "portuguese").alias("s")).collect()
    assert sorted(r.s for r in one) == ["document", "document", "os", "outr", "quilométr"]


def test_own_dictionary(spark):
    ft.register_dictionary("first2", lambda w: w[:2])
    df = spark.createDataFrame([("alpha beta",)], "t string")
    assert df.select(ft.words(F.col("t"), "first2").alias("w")).first().w == ["al", "be"]
    assert ft.py_words("Alpha", "first2") == ["al"]
    with pytest.raises(ValueError):
        ft.words(F.col("t"), "unknown")
