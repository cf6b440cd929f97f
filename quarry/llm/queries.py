"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann
from quarry.llm import decontaminate as dc
from quarry.llm import filteraudit, htmltext, langid, lexical
from quarry.llm import linededup as ld
from quarry.llm import packing, pii
from quarry.llm import quality, sharding
from quarry.llm import simhash as sh
from quarry.llm import warc
from quarry.llm.common import in_fold
from quarry.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# The words of a text and the windows of an item, from the definition: no code
# is shared with the operator.
_OP1_SQL = r"""
WITH low AS (
  SELECT 'd' AS side, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (
  SELECT side, id, regexp_extract_all(coalesce(t, ''),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
win AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS k,
         array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM w WHERE side = 'b' AND len(w) > 0)),
spot AS (
  SELECT d.id, i, k, array_to_string(list_slice(d.w, i, i + k - 1), ' ') AS win
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM w CROSS JOIN (SELECT DISTINCT k FROM win) WHERE side = 'd' AND len(w) >= k) d),
hit AS (SELECT s.id, s.i, s.k, win.item_id FROM spot s JOIN win ON s.k = win.k AND s.win = win.win),
n AS (SELECT id, count(DISTINCT p) AS n_hit
      FROM (SELECT id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY id),
it AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
       FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY id)
SELECT w.id AS doc_id, len(w.w)::BIGINT AS n_words, coalesce(n.n_hit, 0)::BIGINT AS n_hit,
       coalesce(it.n_items, 0)::BIGINT AS n_items, sha256(coalesce(it.names, '')) AS items_sha256,
       coalesce(n.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN n ON n.id = w.id LEFT JOIN it ON it.id = w.id WHERE w.side = 'd'"""


@register("op1_decontaminate", _OP1_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated words and items of every document."""
    found = dc.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, in sequences of at most 4096."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and group."""
    found = sh.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", sh.fp_hex(F.col("fp")).alias("fingerprint"), "component_id")


# Every pair of distinct lines that agree in their first or last word (one edit
# cannot change both) is compared word by word, from the definition.
_OP9_SQL = """
WITH l AS (
  SELECT doc_id, i - 1 AS no, string_split(text, chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM documents)),
o AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, no) AS rn
      FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
f AS (SELECT doc_id, no, w, len(w) AS n, w[1] AS head, w[len(w)] AS tail
      FROM (SELECT doc_id, no, string_split(line, ' ') AS w FROM o WHERE rn = 1)),
p AS (SELECT a.doc_id, a.no, a.w AS aw, b.w AS bw, a.n AS an, b.n AS bn
      FROM f a JOIN f b ON a.head = b.head AND abs(a.n - b.n) <= 1
      WHERE greatest(a.n, b.n) >= 5 AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.no < a.no)
      UNION
      SELECT a.doc_id, a.no, a.w, b.w, a.n, b.n
      FROM f a JOIN f b ON a.tail = b.tail AND abs(a.n - b.n) <= 1
      WHERE greatest(a.n, b.n) >= 5 AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.no < a.no)),
near AS (
  SELECT DISTINCT doc_id, no FROM p
  WHERE CASE WHEN an = bn
             THEN len(list_filter(range(1, an + 1), lambda i: aw[i] <> bw[i])) <= 1
             WHEN an < bn
             THEN len(list_filter(range(1, bn + 1), lambda i:
                  list_concat(list_slice(bw, 1, i - 1), list_slice(bw, i + 1, bn)) = aw)) > 0
             ELSE len(list_filter(range(1, an + 1), lambda i:
                  list_concat(list_slice(aw, 1, i - 1), list_slice(aw, i + 1, an)) = bw)) > 0 END),
gone AS (SELECT doc_id, no, 0 AS near FROM o WHERE rn > 1
         UNION ALL SELECT doc_id, no, 1 FROM near),
t AS (SELECT doc_id, string_agg(l.line, chr(10) ORDER BY l.no) AS kept
      FROM l ANTI JOIN gone USING (doc_id, no) GROUP BY doc_id),
g AS (SELECT doc_id, sum(1 - near) AS n_exact, sum(near) AS n_near,
             string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(string_split(d.text, chr(10)))::BIGINT AS n_lines,
       coalesce(g.n_exact, 0)::BIGINT AS n_exact, coalesce(g.n_near, 0)::BIGINT AS n_near,
       coalesce(g.gone, '') AS gone, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)"""


@register("op9_line_dedup", _OP9_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of every document go, and a digest of the text that stays."""
    found, name = ld.line_report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone, near = F.col(name["gone"]), F.coalesce(F.col(name["near"]), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    text = F.coalesce(ld.kept_text(gone, F.col("text")), F.lit(""))
    return found.select(
        "doc_id", n_lines.cast("long").alias("n_lines"),
        (F.coalesce(F.size(gone), F.lit(0)) - near).cast("long").alias("n_exact"),
        near.cast("long").alias("n_near"),
        F.coalesce(F.array_join(gone.cast("array<string>"), ","), F.lit("")).alias("gone"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


@register("op2_quality_crf")
def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned from labels outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~in_fold("doc_id", 3, 1))
    scored = quality.score(docs, quality.train(docs, labels), keep_text=False)
    return scored.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~in_fold("doc_id", 4, 2)))
    found = langid.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@register("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(pii.names(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.names(F.col("spans")).alias("spans"))


_OP5_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
      WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5"""


@register("op5_block_neighbours", _OP5_SQL)
def op5_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


@register("op6_stratified_shards")
def op6_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal counts and equal mixture."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


_OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
             max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i:
         array_to_string(list_transform(range(0, 4), lambda k:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
             ((('0x' || hex[5 * i + 1:5 * i + 5])::BIGINT >> (15 - 5 * k)) & 31) + 1]), '')), '')
         AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to
FROM d"""


@register("op3_warc_index", _OP3_SQL)
def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, archived, found through the index and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP11_SQL = r"""
WITH raw AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 'q', row_number() OVER (), item_id, text FROM benchmark),
w AS (
  SELECT side, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM raw),
tf AS (SELECT side, r, id, term, count(*) AS tf
       FROM (SELECT side, r, id, unnest(w) AS term FROM w) GROUP BY ALL),
size AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM w WHERE side = 'd' AND len(w) > 0),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
       FROM tf, size WHERE side = 'd' GROUP BY term, n_docs),
m AS (SELECT r, 100 - 90 + (90 * len(w) * n_docs) // n_terms AS m
      FROM w, size WHERE side = 'd' AND len(w) > 0),
scored AS (
  SELECT q.r AS item, q.id AS item_id, d.r, d.id AS doc_id,
         sum(weight * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m)))::BIGINT AS score
  FROM tf q JOIN tf d ON q.term = d.term AND q.side = 'q' AND d.side = 'd'
  JOIN wt ON wt.term = d.term JOIN m ON m.r = d.r GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@register("op11_block_search", _OP11_SQL)
def op11_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 documents that score highest for every benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


# Every document under every order, from the definition: no lattice.
_OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (
  SELECT doc_id, part,
         [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
          100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t),
          regexp_matches(t, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT part, f, len(list_filter(f, lambda v: v)) AS n_fails, coalesce(good, 0) AS good,
             coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)),
n AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, e.i, g.i] AS o FROM n a, n b, n c, n e, n g
      WHERE len(list_distinct([a.i, b.i, c.i, e.i, g.i])) = 5),
gone AS (
  SELECT part, f, n_fails, good, toxic, o, coalesce(
         list_position(list_transform(o, lambda i: f[i]), true), 6) AS fell FROM x, o),
s AS (
  SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, i AS step,
         'ABCDE'[o[i]] AS letter, count(*) FILTER (fell > i) AS kept, count(*) FILTER (fell = i) AS removed,
         count(*) FILTER (f[o[i]] AND fell < i) AS redundant,
         count(*) FILTER (f[o[i]] AND n_fails = 1) AS unique_fails,
         (sum(good) FILTER (fell = i)) AS good_lost, (sum(toxic) FILTER (fell = i)) AS toxic_lost
  FROM gone, n GROUP BY part, o, i)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM s"""


@register("op12_filter_audit", _OP12_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters take from each part, in every order of them."""
    filters = filteraudit.text_filters()
    marked = filteraudit.masks(table(spark, sf_dir, "documents"), filters)
    counts = filteraudit.count_masks(marked, table(spark, sf_dir, "labels"))
    return filteraudit.audit(counts, "".join(filters) + filteraudit.COPY)


# What lies in the article element, by its tags: no line blocks.
_OP13_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''),
                  '(?is)<article[^>]*>(.*)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(t,
             '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>|<nav.*?</nav>|<aside.*?</aside>|<form.*?</form>|<footer.*?</footer>', '', 'g'),
             '(?i)</?(p|br|h[1-6]|li|ul|ol|div|section|tr|td|th|table|blockquote|pre)\b[^>]*>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(
             regexp_replace(t, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)),
             '&nbsp;', chr(160)), '&amp;', '&') AS t FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(t, '[\s\x{A0}]+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d"""


@register("op13_html_text", _OP13_SQL)
def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found, name = htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col(name).alias("text"),
                        F.length(name).cast("long").alias("n_chars"))
