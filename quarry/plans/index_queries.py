"""Registered index queries: inverted index (L11), dictionary (L2), trigram
similarity (L12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions import trigram as tg
from quarry.functions.text import WORD_RE
from quarry.functions.util import spread
from quarry.operators import index as ix
from quarry.plans.oracle_fulltext import q
from quarry.plans.ranking_queries import LIGHT_SQL
from quarry.plans.registry import register
from quarry.session import scratch_path

LOOKUP = ("by", "es", "ha", "from", "at")

_OCC_SQL = f"""occ AS (SELECT doc_id, unnest(l) AS lexeme, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}') AS l FROM documents))"""


@register("inverted_index", f"""WITH {_OCC_SQL}
SELECT lexeme, doc_id, count(*) AS n, min(pos) AS first_pos FROM occ
WHERE lexeme IN ({', '.join(q(x) for x in LOOKUP)}) GROUP BY lexeme, doc_id""")
def inverted_index(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    path = scratch_path(spark, "inverted-index")
    ix.write_index(ix.postings(d, "doc_id", "text"), path, "doc_id")
    hits = ix.lookup(spark, path, LOOKUP)
    return hits.select("lexeme", "doc_id", "n", F.col("positions")[0].alias("first_pos"))


@register("doc_freq", f"""WITH {_OCC_SQL}
SELECT lexeme, count(DISTINCT doc_id) AS n_docs, count(*) AS n_occ FROM occ GROUP BY lexeme""")
def doc_freq(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    return ix.doc_freq(d, "doc_id", "text")


@register("dictionary_map", f"""
SELECT DISTINCT w, {LIGHT_SQL} AS lexeme FROM
  (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}')) AS w FROM documents)""")
def dictionary_map(spark, sf):
    """L2: the distinct vocabulary is mapped once (a stemmer plug-in would run
    per distinct word, not per occurrence)."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    vocab = d.select(F.explode(ft.words(F.col("text"))).alias("w")).distinct()
    return vocab.select("w", ft.apply_dictionary(F.col("w"), "light").alias("lexeme"))


def _grams_sql(expr: str) -> str:
    return (f"list_distinct(flatten(list_transform(regexp_extract_all(lower(coalesce({expr}, '')), '{WORD_RE}'), "
            f"lambda w: list_transform(range(1, length('  ' || w || ' ') - 1), "
            f"lambda i: substring('  ' || w || ' ', i, 3)))))")


def _sim_sql(expr: str, literal: str) -> str:
    a, b = _grams_sql(expr), _grams_sql(q(literal))
    return (f"CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 0.0 ELSE "
            f"len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END")


@register("trigram_similarity", f"""
SELECT p_partkey, round({_sim_sql('p_name', 'small bolt')}, 6) AS sim FROM part
WHERE {_sim_sql('p_name', 'small bolt')} >= 0.08""")
def trigram_similarity(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    s = tg.similarity_to(F.col("p_name"), "small bolt")
    return p.select("p_partkey", s.alias("sim")).where(F.col("sim") >= 0.08).select(
        "p_partkey", F.round("sim", 6).alias("sim"))


@register("trigram_names", f"SELECT n_nationkey, round({_sim_sql('n_name', 'NATION_12')}, 6) AS sim FROM nation")
def trigram_names(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    return n.select("n_nationkey", F.round(tg.similarity_to(F.col("n_name"), "NATION_12"), 6).alias("sim"))


@register("trigram_pairs", f"""
SELECT p_partkey, round({_sim_sql('p_name', 'blue gear')}, 6) AS sim_a,
       round(CASE WHEN len(list_distinct(list_concat({_grams_sql('p_name')}, {_grams_sql('p_type')}))) = 0 THEN 0.0
             ELSE len(list_intersect({_grams_sql('p_name')}, {_grams_sql('p_type')}))
                  / len(list_distinct(list_concat({_grams_sql('p_name')}, {_grams_sql('p_type')}))) END, 6) AS sim_b
FROM part""")
def trigram_pairs(spark, sf):
    """Column-to-column similarity in the same row (no pairs across rows)."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    return p.select("p_partkey", F.round(tg.similarity_to(F.col("p_name"), "blue gear"), 6).alias("sim_a"),
                    F.round(tg.similarity(F.col("p_name"), F.col("p_type")), 6).alias("sim_b"))


@register("trigram_join", f"""
WITH pg AS (SELECT p_partkey, {_grams_sql('p_name')} AS a FROM part),
tt AS (SELECT DISTINCT p_type AS term FROM part WHERE p_type IS NOT NULL),
tg AS (SELECT term, {_grams_sql('term')} AS b FROM tt),
s AS (SELECT p_partkey, term, CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0
             ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS sim FROM pg, tg)
SELECT p_partkey, term, round(sim, 6) AS sim FROM s WHERE sim >= 0.08""")
def trigram_join(spark, sf):
    """L12 join form: part names similar to any part type (the lookup is
    derived from the table and size-checked before it is broadcast)."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    j = tg.fuzzy_join(p, "p_partkey", "p_name", p, "p_type")
    return j.select("p_partkey", "term", F.round("sim", 6).alias("sim"))
