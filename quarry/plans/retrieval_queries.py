"""Registered queries of the indexes: neighbour graph (Q11), lists with early
stop and codes (Q10), block-max text search (L11), prefix-filtered similarity
join (L12), metadata index (M4), token classes and dictionary chain (L1, L2)."""

from __future__ import annotations

import math
import re

from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions import tokens as tk
from quarry.functions import trigram as tg
from quarry.functions.text import WORD_RE
from quarry.functions.util import spread
from quarry.operators import ann, blockmax, bloom, graph, ivf, meta_index, thesaurus
from quarry.operators import embedding as emb
from quarry.plans.index_queries import _grams_sql
from quarry.plans.metadata_queries import _LABELED_META_SQL, _labeled_meta
from quarry.plans.oracle_fulltext import dist_sql
from quarry.plans.registry import ORACLES, register
from quarry.plans import run_queries  # noqa: F401  (the oracle of new_documents)
from quarry.plans.vector_queries import DIM, hash_embed_sql
from quarry.session import scratch_path

NEAREST = 10
RECALL = 0.9


def _stored_vectors(spark, sf):
    """The vectors of all documents that have words, written once; those whose id
    is divisible by 50 are the queries."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    made, path = scratch_path(spark, "made-vectors"), scratch_path(spark, "document-vectors")
    # a filter on vectors not yet written would make each of them twice
    emb.embed(d, "text", DIM).select(F.col("doc_id").alias("id"), "embedding").write.parquet(made)
    graph.directed(spark.read.parquet(made)).select("id", F.col("v").alias("embedding")).write.parquet(path)
    e = spark.read.parquet(path)
    return e, e.where("id % 50 = 0").select(F.col("id").alias("qid"), "embedding")


def _hits(e, queries, found):
    """Per query: rows found, and how many are as near as the exact
    ``NEAREST``-th (copies of a text are equally near)."""
    exact = ann.batch_knn(e, queries, NEAREST).groupBy("qid").agg(
        F.max("dist").alias("far"), F.count("*").alias("wanted"))
    near = (F.col("dist") <= F.col("far") + 1e-6).cast("int")
    return exact.join(found, "qid", "left").groupBy("qid").agg(
        F.max("wanted").alias("wanted"), F.sum(F.coalesce(near, F.lit(0))).alias("hit"))


def _recall_ok(e, queries, found):
    return _hits(e, queries, found).agg((F.sum("hit") >= RECALL * F.sum("wanted")).alias("recall_ok"))


@register("graph_recall", "SELECT true AS recall_ok, true AS few_compared, true AS edges_bounded")
def graph_recall(spark, sf):
    """Q11 over all documents' vectors, every id divisible by 50 a query: at least
    0.9 of the 10 nearest, under a quarter of the vectors compared, and no vector
    with more edges than the graph allows."""
    e, queries = _stored_vectors(spark, sf)
    path = scratch_path(spark, "graph")
    graph.build(e, path)
    n = e.count()
    beam = min(graph.BEAM, max(16, math.isqrt(n) * 3 // 5))  # a small table needs less
    found = graph.search(spark, path, queries, NEAREST, beam=beam, width=beam // 5)
    few = found.select("qid", "compared").distinct().agg(
        (F.avg("compared") < n / 4).alias("few_compared"))
    bounded = spark.read.parquet(f"{path}/edges").groupBy("id").count().agg(
        (F.max("count") <= 2 * graph.DEGREE + graph.LINKS).alias("edges_bounded"))
    one = F.lit(1).alias("_one")
    return (_recall_ok(e, queries, found).withColumn("_one", one).join(few.withColumn("_one", one), "_one")
            .join(bounded.withColumn("_one", one), "_one").drop("_one"))


def _n_lists(n: int) -> int:
    """About as many lists as members of a list."""
    return max(16, math.isqrt(n))


@register("ivf_exact_stop", "WITH " + hash_embed_sql("documents", "doc_id", "text", prefix="hd") + f""",
v AS (SELECT doc_id, v FROM hd WHERE list_sum(v) > 0),
pairs AS (SELECT a.doc_id AS qid, b.doc_id AS id, {dist_sql('cosine', 'b.v', 'a.v::DOUBLE[]')} AS dist
          FROM v a, v b WHERE a.doc_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM pairs)
SELECT qid, id, round(dist, 6) + 0.0 AS dist, rank FROM r WHERE rank <= {NEAREST}""")
def ivf_exact_stop(spark, sf):
    """Q10 with early stop: the exact nearest of every id divisible by 50."""
    e, queries = _stored_vectors(spark, sf)
    lists = ivf.build(e, scratch_path(spark, "exact-lists"), _n_lists(e.count()))
    found = ivf.exact(spark, lists, queries, NEAREST)
    return found.select("qid", "id", (F.round("dist", 6) + 0.0).alias("dist"), "rank")


@register("ivf_pq_recall", "SELECT true AS recall_ok, true AS part_read")
def ivf_pq_recall(spark, sf):
    """Q10 with coded members: an eighth of the lists, as the reference probes, the
    best 100 by codes scored on their vectors. At least 0.9 of the 10 nearest, and
    under three quarters of the codes read (lists of these vectors are very uneven)."""
    e, queries = _stored_vectors(spark, sf)
    n = e.count()
    n_lists = _n_lists(n)
    lists = ivf.build(e, scratch_path(spark, "coded-lists"), n_lists, subspaces=ivf.SUBSPACES)
    found = ivf.coded(spark, lists, queries, NEAREST, max(1, n_lists // 8), 100)
    read = found.select("qid", "coded").distinct().agg((F.avg("coded") < 0.75 * n).alias("part_read"))
    one = F.lit(1).alias("_one")
    return (_recall_ok(e, queries, found).withColumn("_one", one)
            .join(read.withColumn("_one", one), "_one").drop("_one"))


# --- L11 -------------------------------------------------------------------------
@register("index_topk", f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}')) AS lexeme FROM documents),
tf AS (SELECT doc_id, lexeme, count(*) AS n FROM w GROUP BY ALL),
i AS (SELECT *, list_sum(list_transform(range(1, n + 1), lambda j: 1.0::DOUBLE / (j * j))) / {ft.ZETA2} AS impact FROM tf),
q AS (SELECT item_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}')) AS l FROM benchmark),
s AS (SELECT item_id, doc_id, round(sum(impact) / max(len(l)), 9) AS score
      FROM (SELECT item_id, l, unnest(l) AS lexeme FROM q) JOIN i USING (lexeme) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= {NEAREST}""")
def index_topk(spark, sf):
    """The 10 documents that an or-query of every item's words ranks highest,
    by the inverted index with block-max skipping."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    path = scratch_path(spark, "block-index")
    blockmax.build(d, path, "doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("qid"), ft.words(F.col("text")).alias("lexemes"))
    top, _ = blockmax.search(spark, path, items, "doc_id", NEAREST)
    return top.select(F.col("qid").alias("item_id"), "doc_id", F.round("score", 6).alias("score"), "rank")


# --- L12 -------------------------------------------------------------------------
@register("trigram_join_names", f"""
WITH a AS (SELECT DISTINCT p_name AS name FROM part WHERE p_name IS NOT NULL),
g AS (SELECT name, {_grams_sql('name')} AS g FROM a),
s AS (SELECT x.name AS name, y.name AS term,
             len(list_intersect(x.g, y.g)) / len(list_distinct(list_concat(x.g, y.g))) AS sim
      FROM g x, g y WHERE len(x.g) > 0 AND len(y.g) > 0)
SELECT p.p_partkey, s.term, round(s.sim, 6) AS sim FROM part p JOIN s ON s.name = p.p_name WHERE sim >= 0.6""")
def trigram_join_names(spark, sf):
    """L12 join form of a table with itself at a threshold where most grams of a
    name need not be joined."""
    p = spark.read.parquet(f"{sf}/part.parquet")
    j = tg.fuzzy_join(p, "p_partkey", "p_name", p, "p_name", 0.6)
    return j.select("p_partkey", "term", F.round("sim", 6).alias("sim"))


# --- M4 --------------------------------------------------------------------------
@register("meta_index_contains", f"""
WITH m AS ({_LABELED_META_SQL})
SELECT doc_id FROM m WHERE json_contains(metadata, '{{"lang": "en", "labels": {{"quality": 1}}}}')""")
def meta_index_contains(spark, sf):
    """M4 through the index: postings of the filter's tokens are intersected and
    the rows found are tested."""
    d = _labeled_meta(spark, sf)
    path, docs = scratch_path(spark, "meta-index"), scratch_path(spark, "meta-docs")
    d.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(docs)
    stored = spark.read.parquet(docs)
    meta_index.build(stored, path, "doc_id", "metadata")
    hits = meta_index.contains(stored, path, {"lang": "en", "labels": {"quality": 1}}, "doc_id", "metadata")
    return hits.select("doc_id")


# --- L1, L2 ----------------------------------------------------------------------
def _re2(pattern: str) -> str:
    """The pattern for an engine that has no possessive repeats and bounds the sum of
    counted ones; without the bounds on lengths, which only very long names meet."""
    pattern = re.sub(r"\{0,\d+\}", "*", re.sub(r"\{2,\d+\}", "{2,}", pattern))
    return pattern.replace("++", "+").replace("'", "''")


def _class_sql(t: str) -> str:
    rules = [("asciiword", "[A-Za-z]+"), ("word", r"\p{L}+"), ("uint", "[0-9]+"), ("numword", r"[\p{L}\p{N}]+"),
             ("asciihword", "[A-Za-z]+(-[A-Za-z]+)+"), ("hword", r"\p{L}+(-\p{L}+)+")]
    rules += [(c, tk.PATTERNS[c]) for c in ("email", "protocol", "version", "float", "url", "host")]
    return "CASE " + " ".join(f"WHEN regexp_full_match({t}, '{_re2(p)}') THEN '{c}'" for c, p in rules) \
        + " ELSE 'numhword' END"


_TOKENS_SQL = rf"""
t AS (SELECT doc_id, unnest(x) AS token, generate_subscripts(x, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_re2(tk.TOKEN_RE)}') AS x FROM documents)),
c AS (SELECT *, {_class_sql('token')} AS class FROM t),
p AS (SELECT doc_id, i, 0 AS j, class, token FROM c
      UNION ALL
      SELECT doc_id, i, generate_subscripts(x, 1), CASE
             WHEN regexp_full_match(x[generate_subscripts(x, 1)], '[A-Za-z]+') THEN 'hword_asciipart'
             WHEN regexp_full_match(x[generate_subscripts(x, 1)], '\p{{L}}+') THEN 'hword_part' ELSE 'hword_numpart' END,
             unnest(x)
      FROM (SELECT doc_id, i, string_split(token, '-') AS x FROM c WHERE class IN ('asciihword', 'hword', 'numhword'))
      UNION ALL SELECT doc_id, i, 1, 'host', token[1:position('/' IN token) - 1] FROM c WHERE class = 'url'
      UNION ALL SELECT doc_id, i, 2, 'url_path', token[position('/' IN token):] FROM c WHERE class = 'url'),
o AS (SELECT doc_id, class, token, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS pos
      FROM p WHERE class <> 'protocol')"""


@register("tokenize_classes", f"""WITH {_TOKENS_SQL}
SELECT doc_id, class, count(*) AS n, md5(string_agg(pos || ':' || token, ' ' ORDER BY pos)) AS tokens FROM o GROUP BY ALL""")
def tokenize_classes(spark, sf):
    """L1: every document's tokens by class, with their positions."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    o = tk.occurrences(d, "doc_id", "text")
    said = F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))),
                       lambda x: F.concat(x["pos"].cast("string"), F.lit(":"), x["token"]))
    return o.groupBy("doc_id", "class").agg(F.count("*").alias("n"), F.md5(F.array_join(said, " ")).alias("tokens"))


@register("dictionary_chain", f"""WITH {_TOKENS_SQL}
SELECT class, count(DISTINCT token) AS n_tokens,
       CASE WHEN class IN ('asciiword', 'asciihword', 'hword_asciipart') THEN NULL
            ELSE md5(string_agg(DISTINCT token || '>' || lower(token), ' ' ORDER BY token || '>' || lower(token))) END AS copied
FROM o GROUP BY class""")
def dictionary_chain(spark, sf):
    """L2: the distinct tokens of all documents, each mapped once: the ASCII word
    classes by the stemmer, every other class to its lower case (a digest of those
    is compared; stems have no SQL form and are tested on the published pairs)."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    v = tk.vocabulary(d, "text")
    copied = ~F.col("class").isin(*tk.ASCII_CLASSES)  # of the others no list is made
    said = F.array_join(F.sort_array(F.collect_list(F.when(copied, F.concat("token", F.lit(">"), "lexeme")))), " ")
    return v.groupBy("class").agg(F.count("*").alias("n_tokens"), F.when(copied, F.md5(said)).alias("copied"))


# --- T12 -------------------------------------------------------------------------
@register("cooccurrence_thesaurus", f"""
WITH d AS (SELECT regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}') AS w FROM documents),
cnt AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM d) GROUP BY word HAVING count(*) >= {thesaurus.LEAST_COUNT}),
top AS (SELECT word AS context, row_number() OVER (ORDER BY n DESC, word) - 1 AS i FROM cnt
        QUALIFY i < {thesaurus.CONTEXTS}),
pr AS (SELECT w[i] AS word, w[i + o] AS context
       FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT unnest([-2, -1, 1, 2]) AS o)
       WHERE i + o BETWEEN 1 AND len(w)),
p AS (SELECT word, i, count(*) AS n FROM pr JOIN top USING (context) SEMI JOIN cnt USING (word) GROUP BY ALL),
t AS (SELECT sum(n) AS total FROM p),
v AS (SELECT word, i, ln(n * total::DOUBLE / (sum(n) OVER (PARTITION BY word) * (sum(n) OVER (PARTITION BY i))::DOUBLE)) AS x
      FROM p, t),
g AS (SELECT w.word, r.i FROM (SELECT DISTINCT word FROM v WHERE x > 0) w CROSS JOIN range({thesaurus.CONTEXTS}) AS r(i)),
a AS (SELECT g.word, list(greatest(coalesce(v.x, 0.0), 0.0) ORDER BY g.i) AS e
      FROM g LEFT JOIN v ON v.word = g.word AND v.i = g.i GROUP BY g.word),
q AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}')) AS word FROM benchmark),
s AS (SELECT b.word AS token, c.word AS lemma, round(list_cosine_similarity(b.e, c.e), 9) AS sim
      FROM a b SEMI JOIN q USING (word), a c WHERE b.word <> c.word),
r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY sim DESC, lemma) AS lemma_rank FROM s)
SELECT token, lemma_rank, lemma, round(sim, 6) + 0.0 AS sim FROM r WHERE lemma_rank <= {thesaurus.SIMILAR}""")
def cooccurrence_thesaurus(spark, sf):
    """For every word of the items, the words that keep the same company in
    the documents."""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    asked = items.select(F.explode(ft.words(F.col("text"))).alias("token"))
    found = thesaurus.build(d, "text", asked)
    return found.select("token", "lemma_rank", "lemma", (F.round("sim", 6) + 0.0).alias("sim"))


# --- F2 --------------------------------------------------------------------------
@register("new_documents_filtered", ORACLES["new_documents"])
def new_documents_filtered(spark, sf):
    """as ``new_documents``, the ledger guarded by a Bloom filter to which three
    runs appended their keys."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("parent"))
    done = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").cast("string").alias("parent"))
    path = scratch_path(spark, "ledger-filter")
    for run in range(3):
        bloom.append(done.where(F.pmod(F.xxhash64("parent"), F.lit(3)) == run), "parent", path)
    fresh, _ = bloom.new_inputs(d, done, path)
    return fresh.select(F.col("parent").alias("doc_id"))
