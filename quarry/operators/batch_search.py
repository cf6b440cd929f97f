"""Many hybrid / precise searches in one job (Q9 applied to Q7 and Q8).

Every query has its own vector and its own text. Plan:

1. The query set (vectors and texts) is taken in blocks of a fixed size; a
   block is collected, its texts are parsed on the driver into data (``PARSED_QUERY_TYPE``), as the
   single search parses its one literal.
2. Pool: one pass over the table per block of queries (``ann.knn_candidates``,
   an Arrow matrix product with a per-task top-(k*m)); the final k*m per
   query is a window over at most ``k*m x tasks`` rows per query.
3. The pool (``queries x k*m`` rows) is checkpointed and joined to the table by
   id; no id list reaches the driver.
4. Text: the words of the pool rows are exploded and equi-joined with the
   (broadcast, size-checked) query lexemes, so the work is linear in the
   pool's text; the match and ``ts_rank`` are then column expressions over
   each row's query-as-data, one plan whatever the number of queries.
5. Combined score, threshold and the per-query top-k (a window over at most
   k*m rows per query, so no group is larger than the pool).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import jsonb
from quarry.operators import ann
from quarry.operators.search import route_dimension
from quarry.session import cut_lineage

_ENTS = "array<struct<pos: int, w: double>>"


def _parsed_frame(spark, qrows, dictionary: str) -> DataFrame:
    data = [(int(r[0]), ft.parsed_query(r[2], dictionary)) for r in qrows]
    return spark.createDataFrame(data, f"qid long, pq {ft.PARSED_QUERY_TYPE}")


def _fetch(chunks: DataFrame, pool: DataFrame) -> DataFrame:
    """The pool's rows; the join's side and strategy follow the sizes at run time."""
    cols = [c for c in ("id", "content", "metadata", "tsv") if c in chunks.columns]
    return pool.join(chunks.select(*cols), "id")


def _lexeme_positions(rows: DataFrame, qlex: DataFrame, dictionary: str) -> DataFrame:
    """``qid, id, ents``: for each pool row, the map lexeme -> positions of
    the query's lexemes found in the row's text vector."""
    tsv = F.col("tsv") if "tsv" in rows.columns else \
        ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata")), dictionary)
    occ = rows.select("qid", "id", F.inline(tsv))
    hit = occ.join(F.broadcast(qlex), ["qid", "lexeme"])
    per_lex = hit.groupBy("qid", "id", "lexeme").agg(
        F.array_sort(F.collect_list(F.struct("pos", "weight"))).alias("mine"))
    per_lex = per_lex.select("qid", "id", "lexeme", ft.limit_entries(F.col("mine")).alias("ents"))
    return per_lex.groupBy("qid", "id").agg(
        F.map_from_entries(F.collect_list(F.struct("lexeme", "ents"))).alias("lexmap"))


def batch_search(chunks: DataFrame, queries: DataFrame, match_count: int = config.MATCH_COUNT,
                 filter: dict | str | None = None, weight_vec: float = config.WEIGHT_VEC,
                 weight_lex: float = config.WEIGHT_LEX,
                 min_score: float = config.HYBRID_MIN_SCORE,
                 pool_multiplier: int = config.POOL_MULTIPLIER, *, metric: str = "cosine",
                 min_cos_sim: float | None = None, qid_col: str = "qid",
                 qvec_col: str = "embedding", qtext_col: str = "text",
                 dims=config.SUPPORTED_DIMS, dictionary: str = "simple",
                 max_query_bytes: int = ann.MAX_QUERY_BYTES) -> DataFrame:
    """Q7 (``metric="cosine"``) or Q8 (``metric="inner"``, ``min_cos_sim``)
    for every row of ``queries`` (``qid, embedding, text``). Returns ``qid, id,
    content, metadata, score, rank`` with at most ``match_count`` rows per
    query."""
    spark = chunks.sparkSession
    out = None
    for qrows in ann.query_blocks(queries, [qid_col, qvec_col, qtext_col], qid_col, qvec_col,
                                  max_query_bytes):
        part = _search_block(chunks, qrows, match_count, filter, weight_vec, weight_lex, min_score,
                             pool_multiplier, metric, min_cos_sim, dims, dictionary)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame(
            [], "qid long, id long, content string, metadata string, score double, rank int")
    return out


def _search_block(chunks, qrows, match_count, filter, weight_vec, weight_lex, min_score,
                  pool_multiplier, metric, min_cos_sim, dims, dictionary) -> DataFrame:
    """One block of queries, its rows on the driver."""
    spark = chunks.sparkSession
    sizes = {len(r[1]) for r in qrows}
    if len(sizes) != 1:
        raise ValueError(f"one vector size per batch, got {sorted(sizes)}")
    dim = route_dimension(qrows[0][1], dims)
    if "dim" in chunks.columns:
        chunks = chunks.where(F.col("dim") == F.lit(dim))
    pool_size = int(match_count) * int(pool_multiplier)
    base = chunks.where(jsonb.metadata_filter(chunks, filter)) if filter else chunks
    max_dist = None if min_cos_sim is None else 1.0 - float(min_cos_sim)
    cand = ann.knn_candidates(base, [(r[0], r[1]) for r in qrows], pool_size, "id", "embedding",
                              metric, max_dist)
    pool = cut_lineage(ann.top_per_query(cand, pool_size).select("qid", "id", "dist"))
    rows = _fetch(chunks, pool)

    parsed = _parsed_frame(spark, qrows, dictionary)
    qlex = parsed.select("qid", F.explode("pq.lexemes").alias("lexeme"))
    lexmap = _lexeme_positions(rows, qlex, dictionary)
    scored = (rows.join(F.broadcast(parsed), "qid")
                  .join(lexmap, ["qid", "id"], "left"))
    ents = F.transform(F.col("pq.lexemes"), lambda x: F.coalesce(
        F.element_at(F.col("lexmap"), x), F.array().cast(_ENTS)))
    lex = ft.lexical_score_data(F.col("pq"), ents, F.col("content"))
    sim = F.lit(1.0) - F.col("dist")
    s2 = scored.select("qid", "id", "content", "metadata", sim.alias("sim"), lex.alias("lex"))
    score = F.when(F.col("lex") > 0, F.lit(float(weight_vec)) * F.col("sim")
                   + F.lit(float(weight_lex)) * F.col("lex")).otherwise(F.col("sim"))
    out = s2.select("qid", "id", "content", "metadata", score.alias("score")) \
            .where(F.col("score") >= F.lit(float(min_score)))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= int(match_count))
