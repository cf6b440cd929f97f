"""Registered vector and embedding queries (V1-V9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import vectors as vec
from quarry.functions.text import WORD_RE
from quarry.functions.util import spread
from quarry.operators import embedding as emb
from quarry.plans.oracle_fulltext import dist_sql, q
from quarry.plans.registry import register
from quarry.sources.testdata import query_vector, query_vector_sql

DIM = 64


def hash_embed_sql(table: str, key: str, text: str, dim: int = DIM, extra_keys: str = "",
                   prefix: str = "he") -> str:
    """CTE ``{prefix}(key..., v, emb_e6)``: the hashed bag-of-words vector."""
    keys = key + (", " + extra_keys if extra_keys else "")
    kj = " AND ".join(f"b.{k.strip()} = g.{k.strip()}" for k in keys.split(","))
    kn = " AND ".join(f"n.{k.strip()} = g.{k.strip()}" for k in keys.split(","))
    return f"""
{prefix}_t AS (SELECT {keys}, unnest(regexp_extract_all(lower(coalesce({text}, '')), '{WORD_RE}')) AS w FROM {table}),
{prefix}_b AS (SELECT {keys}, ('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS bucket, count(*) AS c
         FROM {prefix}_t GROUP BY ALL),
{prefix}_n AS (SELECT {keys}, sqrt(sum(c * c)) AS nrm FROM {prefix}_b GROUP BY ALL),
{prefix}_g AS (SELECT {keys}, r.i FROM {table} CROSS JOIN range({dim}) AS r(i)),
{prefix}_v AS (SELECT g.*, coalesce(b.c, 0) / coalesce(n.nrm, 1) AS x
         FROM {prefix}_g g LEFT JOIN {prefix}_b b ON {kj} AND b.bucket = g.i LEFT JOIN {prefix}_n n ON {kn}),
{prefix} AS (SELECT {keys}, list(x::FLOAT ORDER BY i) AS v,
              string_agg(CAST(round(x::FLOAT::DOUBLE * 1000000) AS BIGINT)::VARCHAR, ',' ORDER BY i) AS emb_e6
       FROM {prefix}_v GROUP BY ALL)"""


def e6_sql(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: CAST(round(x::DOUBLE * 1000000) AS BIGINT)), ',')"


@register("hash_embed", "WITH " + hash_embed_sql("documents", "doc_id", "text")
          + "\nSELECT doc_id, emb_e6 FROM he")
def hash_embed(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    e = emb.embed(d, "text", DIM)
    return e.select("doc_id", vec.encode_e6(F.col("embedding")).alias("emb_e6"))


@register("fit_dim", f"""
SELECT vec_id, {e6_sql("(list_concat(embedding, list_transform(range(96), lambda i: 0.0::FLOAT)))[1:96]")} AS pad_e6,
       {e6_sql("embedding[1:32]")} AS cut_e6
FROM embeddings""")
def fit_dim(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return e.select("vec_id", vec.encode_e6(vec.fit_dim(F.col("embedding"), 96)).alias("pad_e6"),
                    vec.encode_e6(vec.fit_dim(F.col("embedding"), 32)).alias("cut_e6"))


@register("zero_fallback", f"""
SELECT d.doc_id, e.vec_id IS NULL AS failed,
       {e6_sql("coalesce(e.embedding, list_transform(range(64), lambda i: 0.0::FLOAT))")} AS emb_e6
FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id""")
def zero_fallback(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    j = d.join(e, d.doc_id == e.vec_id, "left")
    return j.select("doc_id", F.col("embedding").isNull().alias("failed"),
                    vec.encode_e6(vec.zero_fallback(F.col("embedding"), DIM)).alias("emb_e6"))


@register("vector_dims", "SELECT vec_id, len(embedding) AS dims FROM embeddings")
def vector_dims(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return e.select("vec_id", vec.vector_dims(F.col("embedding")).alias("dims"))


@register("cosine_distance", f"""WITH qv AS (SELECT {query_vector_sql(0)} AS q)
SELECT vec_id, round({dist_sql('cosine', 'e.embedding', 'qv.q')}, 6) + 0.0 AS dist FROM embeddings e, qv""")
def cosine_distance(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    qv = query_vector(spark, sf, 0)
    return e.select("vec_id", (F.round(vec.cosine_distance(F.col("embedding"), qv), 6) + 0.0).alias("dist"))


@register("neg_inner_product", f"""WITH qv AS (SELECT {query_vector_sql(0)} AS q)
SELECT vec_id, round({dist_sql('inner', 'e.embedding', 'qv.q')}, 6) + 0.0 AS dist FROM embeddings e, qv""")
def neg_inner_product(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    qv = query_vector(spark, sf, 0)
    return e.select("vec_id", (F.round(vec.neg_inner_product(F.col("embedding"), qv), 6) + 0.0).alias("dist"))


@register("embed_list", "WITH " + hash_embed_sql("conversations", "conv_id", "text", extra_keys="turn")
          + "\nSELECT conv_id, turn, emb_e6 FROM he")
def embed_list(spark, sf):
    """V8: a list input gives one vector per element, in order: one row per
    (conversation, turn), never one collected row per conversation."""
    c = spread(spark.read.parquet(f"{sf}/conversations.parquet"))
    e = emb.embed(c, "text", DIM)
    return e.select("conv_id", "turn", vec.encode_e6(F.col("embedding")).alias("emb_e6"))


_ROLE_MODEL = {"user": "sentence-transformers/all-MiniLM-L6-v2", "assistant": "unknown-model"}
DEFAULT_MODEL = emb.MODEL_REGISTRY[0][1]


def _registry_sql() -> str:
    return "(VALUES " + ", ".join(f"({q(k)}, {q(m)}, {d})" for k, m, d in emb.MODEL_REGISTRY) + ") AS r(key, model, dim)"


@register("model_registry", f"""
WITH req AS (SELECT conv_id, turn, coalesce(CASE role {' '.join(f"WHEN {q(r)} THEN {q(m)}" for r, m in _ROLE_MODEL.items())} END,
                                            {q(DEFAULT_MODEL)}) AS model FROM conversations)
SELECT req.conv_id, req.turn, req.model, r.dim, CASE WHEN r.model IS NULL THEN 'rejected' ELSE 'ok' END AS status
FROM req LEFT JOIN {_registry_sql()} ON r.model = req.model""")
def model_registry(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet")
    role = F.col("role")
    model = F.lit(None).cast("string")
    for r, m in _ROLE_MODEL.items():
        model = F.when(role == r, F.lit(m)).otherwise(model)
    req = c.select("conv_id", "turn", model.alias("model"))
    out = emb.resolve_models(req, emb.registry_frame(spark), DEFAULT_MODEL)
    return out.select("conv_id", "turn", "model", "dim", "status")
