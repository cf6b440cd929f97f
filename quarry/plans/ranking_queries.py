"""Registered ranking queries: expansion (T12), rerank (Q13, Q14), batch
search (Q9), approximate search (Q10, Q11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.functions import vectors as vec
from quarry.functions.util import spread
from quarry.functions.text import WORD_RE
from quarry.operators import ann, expansion, rerank
from quarry.operators import chunking as ch
from quarry.operators import embedding as emb
from quarry.operators.search import vector_pool
from quarry.plans.chunk_queries import WS_SQL, chunks_ctes
from quarry.plans.oracle_fulltext import dist_sql, q
from quarry.plans.registry import ORACLES, register
from quarry.plans.vector_queries import DIM, hash_embed_sql
from quarry.session import scratch_path
from quarry.sources.testdata import query_vector, query_vector_sql

LIGHT_SQL = "CASE WHEN regexp_full_match(w, '[a-z]+') THEN regexp_replace(w, '^([a-z]{3,}[^s])s$', '\\1') ELSE w END"


@register("expand_query", f"""
WITH vocab AS (SELECT w, count(*) AS freq FROM
                 (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}')) AS w FROM documents)
               GROUP BY w),
st AS (SELECT w, {LIGHT_SQL} AS stem, freq FROM vocab),
syn AS (SELECT a.w AS token, 1 AS synset_rank,
               row_number() OVER (PARTITION BY a.w ORDER BY b.freq DESC, b.w) AS lemma_rank, b.w AS lemma
        FROM st a JOIN st b ON a.stem = b.stem),
qt AS (SELECT item_id, unnest(list_distinct(list_filter(
              string_split_regex(trim(lower(coalesce(text, '')), {WS_SQL}), {q(tx.WS + '+')}),
              lambda t: t <> ''))) AS token FROM benchmark),
terms AS (SELECT item_id, list_sort(list_distinct(list(replace(lemma, '_', ' ')))) AS terms
          FROM qt JOIN syn ON syn.token = qt.token WHERE synset_rank <= 5 AND lemma_rank <= 5
          GROUP BY item_id)
SELECT b.item_id, b.text || ' ' || coalesce(array_to_string(t.terms, ' '), '') AS expanded
FROM benchmark b LEFT JOIN terms t ON t.item_id = b.item_id""")
def expand_query(spark, sf):
    docs = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    syn = expansion.variant_thesaurus(docs, "text")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    return expansion.expand_queries(bench, "item_id", "text", syn).select("item_id", "expanded")


# --- rerank: every document carries the item at its id modulo the number of
# items as its query (the query key in the file's metadata)
def _reranked(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    b = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("_item"), F.col("text").alias("query"))
    item = F.pmod("doc_id", F.lit(max(1, b.count())))
    chunks = ch.hierarchical_chunks(d.join(b, item == F.col("_item")), "text", ["doc_id", "query"], sep="\n")
    return rerank.rerank(chunks, "doc_id", F.col("query"), F.col("content"))


_RERANK_CTES = chunks_ctes(256, 0.25) + f""",
qs AS (SELECT c.doc_id, c.chunk_index, b.text AS query,
              list_distinct(regexp_extract_all(lower(b.text), '{WORD_RE}')) AS qw,
              regexp_extract_all(lower(c.content), '{WORD_RE}') AS cw
       FROM chunks c JOIN benchmark b ON b.item_id = c.doc_id % (SELECT count(*) FROM benchmark)
       WHERE length(b.text) > 0),
sc AS (SELECT doc_id, chunk_index,
              CASE WHEN len(qw) = 0 THEN 0.0 ELSE len(list_intersect(qw, cw)) / len(qw) END AS score FROM qs),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, chunk_index) AS pos FROM sc)"""


@register("rerank", _RERANK_CTES + "\nSELECT doc_id, chunk_index, round(score, 6) AS score, pos FROM rk")
def rerank_q(spark, sf):
    r = _reranked(spark, sf)
    return r.select("doc_id", "chunk_index", F.round("rerank_score", 6).alias("score"),
                    F.col("rerank_pos").alias("pos"))


@register("rerank_top3", _RERANK_CTES
          + "\nSELECT doc_id, pos, printf('%.4f', round(score, 4)) AS score_4 FROM rk WHERE pos <= 3")
def rerank_top3(spark, sf):
    r = _reranked(spark, sf).where(F.col("rerank_pos") <= 3)
    return r.select("doc_id", F.col("rerank_pos").alias("pos"),
                    F.format_number(F.round("rerank_score", 4), 4).alias("score_4"))


register("rerank_all", _RERANK_CTES + "\nSELECT doc_id, chunk_index, round(score, 6) AS score, pos FROM rk")(rerank_q)


# --- batch search: every benchmark item against every document, both as
# hashed bag-of-words vectors
@register("batch_knn", "WITH " + hash_embed_sql("documents", "doc_id", "text", prefix="hd") + ","
          + hash_embed_sql("benchmark", "item_id", "text", prefix="hq") + f""",
pairs AS (SELECT hq.item_id AS qid, hd.doc_id AS id, {dist_sql('cosine', 'hd.v', 'hq.v::DOUBLE[]')} AS dist
          FROM hq, hd),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist NULLS LAST, id) AS rank FROM pairs)
SELECT qid, id, round(dist, 6) + 0.0 AS dist, rank FROM r WHERE rank <= 10""")
def batch_knn(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    table = emb.embed(d, "text", DIM).select(F.col("doc_id").alias("id"), "embedding")
    qs = emb.embed(spark.read.parquet(f"{sf}/benchmark.parquet"), "text", DIM).select(
        F.col("item_id").alias("qid"), "embedding")
    r = ann.batch_knn(table, qs, 10)
    return r.select("qid", "id", (F.round("dist", 6) + 0.0).alias("dist"), "rank")


@register("batch_knn_grid", ORACLES["batch_knn"])
def batch_knn_grid(spark, sf):
    """Q9 as a grid join: blocks of queries x blocks of documents in one shuffle."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    table = emb.embed(d, "text", DIM).select(F.col("doc_id").alias("id"), "embedding")
    qs = emb.embed(spark.read.parquet(f"{sf}/benchmark.parquet"), "text", DIM).select(
        F.col("item_id").alias("qid"), "embedding")
    r = ann.grid_knn(table, qs, 10)
    return r.select("qid", "id", (F.round("dist", 6) + 0.0).alias("dist"), "rank")


# --- IVF over the stored vectors --------------------------------------------
PROBES = 14  # of 16; the random vectors of the test tables hardly form lists


def _ivf_index(spark, sf, lists=16):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    path = scratch_path(spark, "ivf")
    return path, ann.ivf_build(e, path, lists=lists)


def _ivf(spark, sf, probes):
    path, cents = _ivf_index(spark, sf)
    return ann.ivf_search(spark, path, cents, query_vector(spark, sf, 0), 50, probes=probes)


@register("ivf_full_probe", f"""WITH qv AS (SELECT {query_vector_sql(0)} AS q)
SELECT vec_id AS id, round({dist_sql('cosine', 'e.embedding', 'qv.q')}, 6) + 0.0 AS dist
FROM embeddings e, qv ORDER BY {dist_sql('cosine', 'e.embedding', 'qv.q')}, vec_id LIMIT 50""")
def ivf_full_probe(spark, sf):
    return _ivf(spark, sf, probes=16).select("id", (F.round("dist", 6) + 0.0).alias("dist"))


@register("ivf_probe")
def ivf_probe(spark, sf):
    """Approximate (``PROBES`` of 16 lists): rows only; ``ivf_recall`` holds its
    recall."""
    return _ivf(spark, sf, probes=PROBES).select("id", F.round("dist", 6).alias("dist"))


@register("lsh_knn")
def lsh_knn(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    return ann.lsh_knn(e, query_vector(spark, sf, 0), 50).select("id", F.round("l2", 6).alias("l2"))


def _vectors(spark, sf):
    """The vectors, and those with an id divisible by 50 as queries."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    return e, e.where("id % 50 = 0").select(F.col("id").alias("qid"), "embedding")


def _recall(e, queries, found, floor):
    """One row: least rows found for a query, whether all distances recompute,
    and whether at least ``floor`` of all exact nearest are among them."""
    exact = ann.batch_knn(e, queries, 50).select("qid", "id", F.lit(1).alias("near"))
    asked = queries.select("qid", F.col("embedding").alias("q"))
    true = found.select("qid", "id", "dist").join(e, "id").join(asked, "qid").select(
        "qid", "id", "dist", vec.cosine_distance(F.col("embedding"), F.col("q")).alias("d"))
    per = exact.join(true, ["qid", "id"], "full").groupBy("qid").agg(
        F.count("dist").alias("n"), F.count("near").alias("near"),
        F.count(F.when(F.col("near").isNotNull(), F.col("dist"))).alias("hit"),
        F.bool_and(F.abs(F.col("d") - F.col("dist")) < 1e-6).alias("exact"))
    return per.agg(F.min("n").alias("n"), F.bool_and("exact").alias("exact"),
                   (F.sum("hit") >= floor * F.sum("near")).alias("recall_ok"))


@register("ivf_recall", "SELECT 50 AS n, true AS exact, true AS recall_ok FROM embeddings LIMIT 1")
def ivf_recall(spark, sf):
    """Q10, the lists that ``ivf_probe`` searches: at least 0.9 of the exact 50
    nearest over all queries."""
    e, queries = _vectors(spark, sf)
    path, cents = _ivf_index(spark, sf)
    return _recall(e, queries, ann.ivf_batch(spark, path, cents, queries, 50, PROBES), 0.9)


@register("lsh_recall", "SELECT 50 AS n, true AS exact, true AS recall_ok FROM embeddings LIMIT 1")
def lsh_recall(spark, sf):
    """Q11, the tables that ``lsh_knn`` uses: at least 0.9 of the exact 50
    nearest over all queries."""
    e, queries = _vectors(spark, sf)
    return _recall(e, queries, ann.lsh_batch(e, queries, 50), 0.9)
