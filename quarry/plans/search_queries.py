"""Registered search and full-text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import jsonb
from quarry.functions.util import let, spread
from quarry.operators import search as S
from quarry.plans.oracle_fulltext import (dist_sql, entries_ctes, match_sql, q,
                                          rank_ctes, search_sql)
from quarry.plans.registry import register
from quarry.sources.testdata import (DOC_CHUNKS_SQL, doc_chunks, query_vector,
                                     query_vector_sql)

DIMS = config.SUPPORTED_DIMS + (64,)
QTEXT = "at by"
PHRASE = '"of the"'
FILTER = {"lang": "en"}
FILTER_JSON = '{"lang": "en"}'


def _out(df):
    return df.select("id", "content", "metadata", F.round("score", 6).alias("score"))


def _chunks_qv(spark, sf):
    return doc_chunks(spark, sf), query_vector(spark, sf, 0)


@register("match_hybrid", search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), QTEXT))
def match_hybrid(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return _out(S.match_hybrid(ch, qv, QTEXT, dims=DIMS))


@register("match_hybrid_filtered",
          search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), QTEXT, filter_json=FILTER_JSON))
def match_hybrid_filtered(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return _out(S.match_hybrid(ch, qv, QTEXT, filter=FILTER, dims=DIMS))


@register("match_hybrid_phrase", search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), PHRASE))
def match_hybrid_phrase(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return _out(S.match_hybrid(ch, qv, PHRASE, dims=DIMS))


@register("match_hybrid_notext", search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), None))
def match_hybrid_notext(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return _out(S.match_hybrid(ch, qv, None, dims=DIMS))


@register("match_hybrid_websearch",
          search_sql(DOC_CHUNKS_SQL, query_vector_sql(3), "from or es -zzz", match_count=10))
def match_hybrid_websearch(spark, sf):
    ch = doc_chunks(spark, sf)
    qv = query_vector(spark, sf, 3)
    return _out(S.match_hybrid(ch, qv, "from or es -zzz", match_count=10, dims=DIMS))


@register("match_precise",
          search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), QTEXT, min_score=0.5, metric="inner",
                     min_cos_sim=0.8))
def match_precise(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return _out(S.match_precise(ch, qv, QTEXT, dims=DIMS))


@register("match_precise_cosine",
          search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), QTEXT, min_score=0.5, metric="cosine",
                     min_cos_sim=0.1))
def match_precise_cosine(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return _out(S.match_precise(ch, qv, QTEXT, min_cos_sim=0.1, metric="cosine", dims=DIMS))


# --- pool alone -------------------------------------------------------------
def _pool_sql(metric, floor=None, k=50, filt=None):
    where = [f"json_contains(c.metadata, {q(filt)})"] if filt else []
    d = dist_sql(metric, "c.embedding", "qv.q")
    if floor is not None:
        where.append(f"{d} <= {floor!r}")
    w = ("WHERE " + " AND ".join(where)) if where else ""
    return f"""WITH chunks AS ({DOC_CHUNKS_SQL}), qv AS (SELECT {query_vector_sql(0)} AS q)
SELECT c.id, round({d}, 6) + 0.0 AS dist FROM chunks c, qv {w} ORDER BY {d}, c.id LIMIT {k}"""


@register("knn_topk", _pool_sql("cosine"))
def knn_topk(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return S.vector_pool(ch, qv, 50).select("id", F.round("dist", 6).alias("dist"))


@register("knn_topk_filtered", _pool_sql("cosine", filt='{"lang": "de"}'))
def knn_topk_filtered(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return S.vector_pool(ch, qv, 50, filter={"lang": "de"}).select(
        "id", F.round("dist", 6).alias("dist"))


@register("knn_threshold", _pool_sql("inner", floor=1.0 - 0.8))
def knn_threshold(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    return S.vector_pool(ch, qv, 50, metric="inner", max_dist=1.0 - 0.8).select(
        "id", F.round("dist", 6).alias("dist"))


# --- scores on the pool -----------------------------------------------------
@register("lexical_score", search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), QTEXT, final=False)
          + "\nSELECT id, round(sim, 6) AS sim, round(lex, 6) AS lex FROM fin")
def lexical_score(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    pool = S.vector_pool(ch, qv, 50)
    rows = ch.join(pool, "id")
    tsv = ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata")))
    lex = ft.lexical_score(QTEXT, tsv, F.col("content"))
    return rows.select("id", F.round(F.lit(1.0) - F.col("dist"), 6).alias("sim"),
                       F.round(lex, 6).alias("lex"))


@register("score_combine", search_sql(DOC_CHUNKS_SQL, query_vector_sql(0), PHRASE, final=False)
          + "\nSELECT id, round(score, 6) AS score FROM fin")
def score_combine(spark, sf):
    ch, qv = _chunks_qv(spark, sf)
    pool = S.vector_pool(ch, qv, 50)
    rows = ch.join(pool, "id")
    tsv = ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata")))
    lex = ft.lexical_score(PHRASE, tsv, F.col("content"))
    sim = F.lit(1.0) - F.col("dist")
    score = F.when(lex > 0, 0.6 * sim + 0.4 * lex).otherwise(sim)
    return rows.select("id", F.round(score, 6).alias("score"))


# --- full text over whole tables ------------------------------------------
def _doc_text_sql(tq_text: str, phrase: bool = False, with_rank: bool = True) -> str:
    tq = ft.phrase_query(tq_text) if phrase else ft.websearch_query(tq_text)
    lexs = tq.distinct_lexemes()
    idx = {x: k for k, x in enumerate(lexs)}
    src = "src AS (SELECT doc_id AS id, text AS content FROM documents),"
    ctes = "WITH " + src + entries_ctes("src", lexs, meta=None)
    ctes += rank_ctes(tq)
    m = match_sql(tq.tree, idx, "ls")
    sel = ", round(rk.rank, 6) AS rank" if with_rank else ""
    return (ctes + f"\nSELECT s.id AS doc_id{sel} FROM src s LEFT JOIN lists ls ON ls.id = s.id "
            f"LEFT JOIN rk ON rk.id = s.id WHERE {m}")


def _doc_text(spark, sf, tq, with_rank=True):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    mr = ft.match_rank(tq, ft.text_vector(F.col("text")))
    # one evaluation per row: a generator is not pushed below or duplicated
    hits = d.select("doc_id", F.inline(F.filter(F.array(mr), lambda x: x.match)))
    cols = [F.col("doc_id")] + ([F.round("rank", 6).alias("rank")] if with_rank else [])
    return hits.select(*cols)


@register("ts_rank", _doc_text_sql("at by"))
def ts_rank(spark, sf):
    return _doc_text(spark, sf, ft.websearch_query("at by"))


@register("ts_rank_or", _doc_text_sql("from or ha"))
def ts_rank_or(spark, sf):
    return _doc_text(spark, sf, ft.websearch_query("from or ha"))


@register("phrase_match", _doc_text_sql("of the", phrase=True))
def phrase_match(spark, sf):
    return _doc_text(spark, sf, ft.phrase_query("of the"))


@register("websearch_match", _doc_text_sql('"of the" es -by', with_rank=False))
def websearch_match(spark, sf):
    return _doc_text(spark, sf, ft.websearch_query('"of the" es -by'), with_rank=False)


@register("ilike_match", f"SELECT doc_id FROM documents WHERE text ILIKE {q(ft.like_pattern('the_t'))} ESCAPE '\\'")
def ilike_match(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.where(ft.ilike_contains(F.col("text"), "the_t")).select("doc_id")


@register("tokenize", """
SELECT doc_id, count(*) AS n_words, count(DISTINCT w) AS n_lexemes, min(w) AS first_lexeme, max(w) AS last_lexeme
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS w FROM documents)
GROUP BY doc_id""")
def tokenize(spark, sf):
    """L1 per document. ``doc_id`` is the table's key, so the statistics are
    array functions inside each row: no word is exploded or shuffled.
    Documents without a word have no row, as in the grouped form."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    stats = let({"w": ft.words(F.col("text"))}, lambda s: F.struct(
        F.size(s.w).alias("n_words"), F.size(F.array_distinct(s.w)).alias("n_lexemes"),
        F.array_min(s.w).alias("first_lexeme"), F.array_max(s.w).alias("last_lexeme")))
    return d.select("doc_id", stats.alias("s")).select("doc_id", "s.*").where(F.col("n_words") > 0)


@register("tsv_full", f"""
WITH c AS ({DOC_CHUNKS_SQL}),
a AS (SELECT id, l FROM (SELECT id, regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}]+') AS l FROM c)),
b AS (SELECT id, regexp_extract_all(lower(metadata), '[\\p{{L}}\\p{{N}}]+') AS l FROM c)
SELECT a.id, len(a.l) + len(b.l) AS n_entries, len(b.l) AS n_b,
       len(a.l) + len(b.l) AS last_pos,
       b.l[1] AS first_b, b.l[-1] AS last_b
FROM a JOIN b ON a.id = b.id""")
def tsv_full(spark, sf):
    ch = doc_chunks(spark, sf)
    tsv = ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata")))
    t = ch.select("id", tsv.alias("tsv"))
    bs = F.filter("tsv", lambda e: e.weight == "B")
    return t.select("id", F.size("tsv").alias("n_entries"), F.size(bs).alias("n_b"),
                    F.try_element_at("tsv", F.lit(-1)).pos.alias("last_pos"),
                    F.try_element_at(bs, F.lit(1)).lexeme.alias("first_b"),
                    F.try_element_at(bs, F.lit(-1)).lexeme.alias("last_b"))


@register("dim_routing", f"""
SELECT vec_id, len(embedding) AS dims,
       CASE WHEN len(embedding) IN ({', '.join(str(d) for d in DIMS)}) THEN 'documents_' || len(embedding)
            ELSE 'unsupported' END AS route
FROM embeddings""")
def dim_routing(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    n = F.size("embedding")
    return e.select("vec_id", n.alias("dims"),
                    F.when(n.isin(*DIMS), F.concat(F.lit("documents_"), n.cast("string")))
                     .otherwise(F.lit("unsupported")).alias("route"))
