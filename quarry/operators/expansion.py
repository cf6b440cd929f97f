"""Query expansion with a synonym table.

The synonym table ``token, synset_rank, lemma_rank, lemma`` is the user's
(a thesaurus export); ``variant_thesaurus`` derives a small one from a corpus
for tests and examples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import text as tx


def query_tokens(text) -> F.Column:
    """Distinct lower-cased white-space separated tokens (punctuation kept)."""
    parts = F.split(tx.ustrip(F.lower(F.coalesce(text, F.lit("")))), f"{tx.WS}+", -1)
    return F.array_distinct(F.filter(parts, lambda t: t != F.lit("")))


def expand_queries(queries: DataFrame, key: str, text_col: str, synonyms: DataFrame,
                   top_k: int = config.EXPANSION_TOP_K, out: str = "expanded") -> DataFrame:
    """``text + ' ' + terms``: the lemmas of the first ``top_k`` synsets
    and first ``top_k`` lemmas of each token, ``_`` read as a space, each
    term once. The terms are sorted (the original order is undefined); a
    query without terms keeps a trailing space."""
    toks = queries.select(key, F.explode(query_tokens(F.col(text_col))).alias("token"))
    syn = (synonyms.where((F.col("synset_rank") <= top_k) & (F.col("lemma_rank") <= top_k))
           .select("token", F.replace(F.col("lemma"), F.lit("_"), F.lit(" ")).alias("term")))
    terms = (toks.join(syn, "token")
             .groupBy(key).agg(F.array_sort(F.collect_set("term")).alias("_terms")))
    j = queries.join(terms, key, "left")
    return j.withColumn(out, F.concat(F.col(text_col), F.lit(" "),
                                      F.coalesce(F.array_join("_terms", " "), F.lit("")))).drop("_terms")


def variant_thesaurus(docs: DataFrame, text_col: str) -> DataFrame:
    """A synonym table from a corpus: the words that share a light stem are
    one synset (rank 1), their lemmas ranked by frequency. A stem group holds
    a word and its plural, so it stays tiny."""
    counts = docs.select(F.explode(ft.words(F.col(text_col))).alias("w")).groupBy("w").count()
    stems = counts.withColumn("stem", ft.apply_dictionary(F.col("w"), "light"))
    lemmas = stems.select("stem", F.col("w").alias("lemma"), F.col("count").alias("freq"))
    w = Window.partitionBy("token").orderBy(F.col("freq").desc(), F.col("lemma"))
    return (stems.select(F.col("w").alias("token"), "stem").join(lemmas, "stem")
            .select("token", F.lit(1).alias("synset_rank"),
                    F.row_number().over(w).alias("lemma_rank"), "lemma"))
