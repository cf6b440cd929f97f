"""Registered batch hybrid search (Q9 over Q7): every ``benchmark`` row is a
query, its vector the hashed embedding of its text, its text query the text
itself, searched over the documents with their hashed embeddings.

The oracle is an independent SQL formulation with the query as data: the
text is split into whitespace tokens, ``or`` tokens open a new group, the
lexemes of a group are AND-ed; positions come from a keyed version of the
text-vector CTEs and the rank from the pair self-join. It covers the syntax
that occurs in ``benchmark`` (words and ``or``; no quotes, no ``-``, no
backslash, checked at sf0.001, sf0.01 and sf0.1); the Spark side parses the
whole web syntax (tested in ``tests/test_batch_search.py``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import text as tx
from quarry.functions.text import WORD_RE
from quarry.functions.util import spread
from quarry.operators import batch_search as BS
from quarry.operators import embedding as emb
from quarry.plans.oracle_fulltext import dist_sql, q
from quarry.plans.registry import register
from quarry.plans.vector_queries import DIM, hash_embed_sql
from quarry.sources.testdata import PARENT_SQL, parent_name

W_A = config.RANK_WEIGHTS["A"]
W_B = config.RANK_WEIGHTS["B"]
POOL = config.MATCH_COUNT * config.POOL_MULTIPLIER


def _words(expr: str) -> str:
    return f"regexp_extract_all(lower(coalesce({expr}, '')), '{WORD_RE}')"


BATCH_HYBRID_SQL = "WITH " + hash_embed_sql("documents", "doc_id", "text", prefix="hd") + "," \
    + hash_embed_sql("benchmark", "item_id", "text", prefix="hq") + f""",
chunks AS (SELECT d.doc_id AS id, d.text AS content,
                  json_object('lang', d.lang, 'source', d.source, '__parent', {PARENT_SQL})::VARCHAR AS metadata,
                  hd.v AS embedding
           FROM documents d JOIN hd USING (doc_id)),
qs AS (SELECT b.item_id AS qid, b.text AS qtext, hq.v::DOUBLE[] AS qv FROM benchmark b JOIN hq ON hq.item_id = b.item_id),
scored AS (SELECT qs.qid, c.id, c.content, c.metadata, {dist_sql('cosine', 'c.embedding', 'qs.qv')} AS dist
           FROM qs, chunks c),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist NULLS LAST, id) AS r FROM scored)
         WHERE r <= {POOL}),
tok AS (SELECT qid, unnest(l) AS tok, generate_subscripts(l, 1) AS ti
        FROM (SELECT qid, list_filter(string_split_regex(qtext, {q(tx.WS + '+')}), lambda t: t <> '') AS l FROM qs)),
tokg AS (SELECT qid, tok, sum(CASE WHEN lower(tok) = 'or' THEN 1 ELSE 0 END) OVER (PARTITION BY qid ORDER BY ti) AS gi
         FROM tok),
qgl AS (SELECT DISTINCT qid, gi, unnest({_words('tok')}) AS lexeme FROM tokg WHERE lower(tok) <> 'or'),
qlex AS (SELECT DISTINCT qid, lexeme FROM qgl),
qinfo AS (SELECT qid, count(DISTINCT gi) = 1 AND count(DISTINCT lexeme) >= 2 AS use_and,
                 count(DISTINCT lexeme) AS nlex FROM qgl GROUP BY qid),
ta AS (SELECT qid, id, unnest(l) AS lexeme, generate_subscripts(l, 1) AS i
       FROM (SELECT qid, id, {_words('content')} AS l FROM pool)),
mx AS (SELECT qid, id, len({_words('content')}) AS maxpos FROM pool),
ea0 AS (SELECT DISTINCT ta.qid, ta.id, ta.lexeme, ta.i AS pos
        FROM ta JOIN qlex ON qlex.qid = ta.qid AND qlex.lexeme = ta.lexeme),
ea1 AS (SELECT *, row_number() OVER (PARTITION BY qid, id, lexeme ORDER BY pos) AS j FROM ea0),
eak AS (SELECT qid, id, lexeme, pos, j FROM ea1),
astat AS (SELECT qid, id, lexeme, count(*) AS na, max(pos) AS lasta FROM eak GROUP BY qid, id, lexeme),
tb AS (SELECT qid, id, unnest(l) AS lexeme, generate_subscripts(l, 1) AS i
       FROM (SELECT qid, id, {_words('metadata')} AS l FROM pool)),
eb0 AS (SELECT DISTINCT tb.qid, tb.id, tb.lexeme, tb.i + mx.maxpos AS pos
        FROM tb JOIN mx ON tb.qid = mx.qid AND tb.id = mx.id
                JOIN qlex ON qlex.qid = tb.qid AND qlex.lexeme = tb.lexeme),
eb1 AS (SELECT *, row_number() OVER (PARTITION BY qid, id, lexeme ORDER BY pos) AS jb FROM eb0),
ebk AS (SELECT eb1.qid, eb1.id, eb1.lexeme, eb1.pos, coalesce(a.na, 0) + eb1.jb AS j
        FROM eb1 LEFT JOIN astat a ON a.qid = eb1.qid AND a.id = eb1.id AND a.lexeme = eb1.lexeme),
ent AS (SELECT qid, id, lexeme, pos, {W_A} AS w, j FROM eak
        UNION ALL SELECT qid, id, lexeme, pos, {W_B} AS w, j FROM ebk),
present AS (SELECT DISTINCT qid, id, lexeme FROM ent),
gm AS (SELECT p.qid, p.id, g.gi FROM pool p JOIN qgl g ON g.qid = p.qid
       LEFT JOIN present e ON e.qid = p.qid AND e.id = p.id AND e.lexeme = g.lexeme
       GROUP BY p.qid, p.id, g.gi HAVING count(e.lexeme) = count(*)),
mt AS (SELECT DISTINCT qid, id FROM gm),
pr AS (SELECT e1.qid, e1.id,
              product(1 - sqrt(e1.w * e2.w * CASE WHEN abs(e1.pos - e2.pos) > 100 THEN 1e-30
                       ELSE 1.0 / (1.005 + 0.05 * exp(abs(e1.pos - e2.pos) / 1.5 - 2)) END)) AS prod,
              count(*) AS np
       FROM ent e1 JOIN ent e2 ON e1.qid = e2.qid AND e1.id = e2.id AND e1.lexeme < e2.lexeme AND e1.pos <> e2.pos
       GROUP BY e1.qid, e1.id),
pl AS (SELECT qid, id, lexeme, max(w) AS wmax, sum(w / (j * j)) AS s FROM ent GROUP BY qid, id, lexeme),
pj AS (SELECT e.qid, e.id, e.lexeme, min(e.j) AS jm FROM ent e
       JOIN pl ON pl.qid = e.qid AND pl.id = e.id AND pl.lexeme = e.lexeme WHERE e.w = pl.wmax
       GROUP BY e.qid, e.id, e.lexeme),
ror AS (SELECT pl.qid, pl.id, sum((pl.wmax + pl.s - pl.wmax / (pj.jm * pj.jm)) / {ft.ZETA2}) AS tot
        FROM pl JOIN pj ON pj.qid = pl.qid AND pj.id = pl.id AND pj.lexeme = pl.lexeme GROUP BY pl.qid, pl.id),
rk AS (SELECT p.qid, p.id,
              CASE WHEN qi.use_and THEN (CASE WHEN coalesce(pr.np, 0) > 0 THEN 1 - pr.prod ELSE 1e-20 END)
                   ELSE coalesce(ror.tot, 0) / qi.nlex END AS rank
       FROM pool p JOIN qinfo qi ON qi.qid = p.qid
       LEFT JOIN pr ON pr.qid = p.qid AND pr.id = p.id LEFT JOIN ror ON ror.qid = p.qid AND ror.id = p.id),
s2 AS (SELECT p.qid, p.id, 1 - p.dist AS sim,
              coalesce(CASE WHEN mt.id IS NOT NULL THEN (CASE WHEN rk.rank < 0 THEN 1e-20 ELSE rk.rank END)
                            WHEN p.content ILIKE '%' || qs.qtext || '%' ESCAPE '\\' THEN 1.0 ELSE 0.0 END, 0.0) AS lex
       FROM pool p JOIN qs ON qs.qid = p.qid
       LEFT JOIN mt ON mt.qid = p.qid AND mt.id = p.id LEFT JOIN rk ON rk.qid = p.qid AND rk.id = p.id),
fin AS (SELECT qid, id, CASE WHEN lex > 0 THEN 0.6 * sim + 0.4 * lex ELSE sim END AS score FROM s2),
top AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM fin WHERE score >= 0.1)
SELECT qid, id, round(score, 6) AS score, rank FROM top WHERE rank <= 5"""


def batch_chunks(spark, sf):
    """The documents as a chunk table with hashed embeddings."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    e = emb.embed(d, "text", DIM)
    meta = F.to_json(F.struct(F.col("lang"), F.col("source"), parent_name(F.col("doc_id")).alias("__parent")))
    return e.select(F.col("doc_id").alias("id"), F.col("text").alias("content"), meta.alias("metadata"),
                    "embedding")


@register("batch_hybrid", BATCH_HYBRID_SQL)
def batch_hybrid(spark, sf):
    qs = emb.embed(spark.read.parquet(f"{sf}/benchmark.parquet"), "text", DIM).select(
        F.col("item_id").alias("qid"), "embedding", "text")
    r = BS.batch_search(batch_chunks(spark, sf), qs, dims=(DIM,))
    return r.select("qid", "id", F.round("score", 6).alias("score"), "rank")
