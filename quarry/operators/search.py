"""Hybrid and precise search over a chunk table (Q1-Q8).

Plan shape, per call:

1. partition-pruned scan of ``id, embedding, metadata`` (S12, S13), the JSON
   containment filter (M4), the distance, an optional distance floor, and
   ``orderBy(dist, id).limit(k*m)``: Spark runs this as TakeOrderedAndProject,
   a per-task top-(k*m) then one merge of k*m rows per task; the only data
   that crosses tasks.
2. Pool rows are fetched back by id. Up to ``MAX_POOL`` ids are pushed to the
   scan as an OR of equalities (an ``IN`` of more than ten values would prune by
   its least and greatest value only), so row groups without any of them are
   skipped; a larger pool is joined.
3. Lexical score, combined score, threshold and the final top-k run on those
   k*m rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import jsonb
from quarry.functions import vectors as vec
from quarry.operators import vector_scan

RESULT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

MAX_POOL = 1_000  # ids that are pushed to the scan as literals; larger pools are joined


def route_dimension(query_embedding: Sequence[float], dims: Sequence[int]) -> int:
    """The table partition of a query vector; other sizes are refused."""
    d = len(query_embedding)
    if d not in tuple(dims):
        raise ValueError(f"unsupported dimension: {d}")
    return d


def distance(metric: str, emb: Column, q: Sequence[float]) -> Column:
    if metric == "cosine":
        return vec.cosine_distance(emb, q)
    if metric == "inner":
        return vec.neg_inner_product(emb, q)
    raise ValueError(metric)


def vector_pool(chunks: DataFrame, query_embedding: Sequence[float], pool_size: int,
                filter: dict | str | None = None, metric: str = "cosine",
                max_dist: float | None = None, impl: str = "arrow") -> DataFrame:
    """Q1 / Q2: ``id, dist`` of the first ``pool_size`` rows passing the
    filter (and the distance floor), by distance then id. ``impl``: the
    distance through Arrow (``vector_scan``) or as a native expression."""
    base = chunks
    if filter:
        base = base.where(jsonb.metadata_filter(base, filter))
    if vector_scan.choose(impl) == "arrow":
        scored = vector_scan.distances(base, query_embedding, metric)
    else:
        scored = base.select("id", distance(metric, F.col("embedding"), query_embedding).alias("dist"))
    if max_dist is not None:
        # The floor as a NULL distance, not a filter: Catalyst would push a
        # filter below the projection with the distance inlined, computing
        # it twice. NULLs sort last, so the first rows are the first rows
        # within the floor; the NULLs are dropped after the limit.
        scored = scored.select("id", F.when(F.col("dist") <= F.lit(float(max_dist)),
                                            F.col("dist")).alias("dist"))
    # ascending puts NULL last (a NULL vector never takes a pool place first)
    top = scored.orderBy(F.col("dist").asc_nulls_last(), F.col("id").asc()).limit(int(pool_size))
    return top if max_dist is None else top.where(F.col("dist").isNotNull())


def id_in(ids: Sequence[int], col: str = "id") -> Column:
    """``col`` is one of ``ids``, as a balanced OR of ``IN`` lists short enough
    for the scan to test each value against a row group's statistics."""
    parts = [F.col(col).isin(list(ids[i:i + 10])) for i in range(0, len(ids), 10)]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2:]
    return parts[0]


def _fetch_pool(chunks: DataFrame, pool: DataFrame, late: bool) -> DataFrame:
    spark = chunks.sparkSession
    if not late:
        return chunks.join(pool, "id")
    rows = pool.collect()  # at most k*m rows, checked by the caller
    if not rows:
        return spark.createDataFrame([], "id long, dist double").join(chunks, "id")
    pool_df = spark.createDataFrame(
        [(int(r["id"]), None if r["dist"] is None else float(r["dist"])) for r in rows],
        "id long, dist double")
    fetched = chunks.where(id_in([int(r["id"]) for r in rows]))
    return fetched.join(F.broadcast(pool_df), "id")


def search(chunks: DataFrame, query_embedding: Sequence[float], query_text: str | None = None,
           match_count: int = config.MATCH_COUNT, filter: dict | str | None = None,
           weight_vec: float = config.WEIGHT_VEC, weight_lex: float = config.WEIGHT_LEX,
           min_score: float = config.HYBRID_MIN_SCORE,
           pool_multiplier: int = config.POOL_MULTIPLIER, *, metric: str = "cosine",
           min_cos_sim: float | None = None, dims: Sequence[int] = config.SUPPORTED_DIMS,
           dictionary: str = "simple", late: bool = True, impl: str = "arrow") -> DataFrame:
    """Shared body of Q7 and Q8. Returns ``id, content, metadata, score``."""
    dim = route_dimension(query_embedding, dims)
    if "dim" in chunks.columns:
        chunks = chunks.where(F.col("dim") == F.lit(dim))
    pool_size = int(match_count) * int(pool_multiplier)
    max_dist = None if min_cos_sim is None else 1.0 - float(min_cos_sim)
    pool = vector_pool(chunks, query_embedding, pool_size, filter, metric, max_dist, impl)
    rows = _fetch_pool(chunks, pool, late and pool_size <= MAX_POOL)
    tsv = F.col("tsv") if "tsv" in chunks.columns else \
        ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata")), dictionary)
    sim = F.lit(1.0) - F.col("dist")
    lex = ft.lexical_score(query_text, tsv, F.col("content"), dictionary)
    scored = rows.select("id", "content", "metadata", sim.alias("sim"), lex.alias("lex"))
    score = F.when(F.col("lex") > 0, F.lit(float(weight_vec)) * F.col("sim")
                   + F.lit(float(weight_lex)) * F.col("lex")).otherwise(F.col("sim"))
    out = scored.select("id", "content", "metadata", score.alias("score"))
    return (out.where(F.col("score") >= F.lit(float(min_score)))
               .orderBy(F.col("score").desc(), F.col("id").asc())
               .limit(int(match_count)))


def match_hybrid(chunks: DataFrame, query_embedding: Sequence[float], query_text: str | None = None,
                 match_count: int = config.MATCH_COUNT, filter: dict | str | None = None,
                 weight_vec: float = config.WEIGHT_VEC, weight_lex: float = config.WEIGHT_LEX,
                 min_score: float = config.HYBRID_MIN_SCORE,
                 pool_multiplier: int = config.POOL_MULTIPLIER, **kw) -> DataFrame:
    """Q7: cosine pool, text re-scoring, threshold, top-k."""
    return search(chunks, query_embedding, query_text, match_count, filter, weight_vec,
                  weight_lex, min_score, pool_multiplier, metric="cosine", **kw)


def match_precise(chunks: DataFrame, query_embedding: Sequence[float], query_text: str | None = None,
                  match_count: int = config.MATCH_COUNT, filter: dict | str | None = None,
                  weight_vec: float = config.WEIGHT_VEC, weight_lex: float = config.WEIGHT_LEX,
                  min_cos_sim: float = config.PRECISE_MIN_COS_SIM,
                  min_score: float = config.PRECISE_MIN_SCORE,
                  pool_multiplier: int = config.POOL_MULTIPLIER, *, metric: str = "inner",
                  **kw) -> DataFrame:
    """Q8. ``metric="inner"``: the negative inner product and its floor
    ``-(a.q) <= 1 - min_cos_sim``, ``sim = 1 + a.q`` (literal behaviour);
    ``metric="cosine"``: the floor on the true cosine."""
    return search(chunks, query_embedding, query_text, match_count, filter, weight_vec,
                  weight_lex, min_score, pool_multiplier, metric=metric,
                  min_cos_sim=min_cos_sim, **kw)
