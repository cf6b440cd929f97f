"""Registered paragraph and chunking queries (T1-T11, T14, T15) over
``documents``. The fixture texts hold no blank line, so these queries split
on a single newline; the operators take the separator as a parameter."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.functions.util import spread
from quarry.operators import chunking as ch
from quarry.plans.oracle_fulltext import q
from quarry.plans.registry import register

SEP = "\n"
MAXTOK = 256
RATIO = 0.25
OVERLAP = int(MAXTOK * RATIO)
WS_SQL = "(" + "||".join(f"chr({ord(c)})" for c in tx.WS_CHARS) + ")"
TOC_LINE_SQL = q(tx.TOC_LINE_RE)
TOC_KEY_SQL = q(tx.TOC_KEYWORD_RE)
TOKEN_SQL = q(tx.TOKEN_RE)
TOKEN_WS_SQL = q(tx.TOKEN_WS_RE)


def _docs(spark, sf):
    return spread(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))


PARAS_SQL = f"""
p0 AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
                                                 lambda x: trim(x, {WS_SQL})), lambda x: x <> '') AS l
       FROM documents),
p1 AS (SELECT doc_id, unnest(l) AS para, generate_subscripts(l, 1) - 1 AS pos FROM p0)"""

KEEP_SQL = (f"NOT regexp_matches(lower(para), {TOC_KEY_SQL}) AND NOT regexp_matches(para, {TOC_LINE_SQL}) "
            f"AND length(para) >= 50")

FILTERED_SQL = PARAS_SQL + f""",
f0 AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
                                                 lambda x: trim(x, {WS_SQL})),
              lambda para: para <> '' AND {KEEP_SQL}) AS l FROM documents),
f1 AS (SELECT doc_id, unnest(l) AS para, generate_subscripts(l, 1) - 1 AS pos FROM f0)"""


@register("paragraph_split", "WITH " + PARAS_SQL + "\nSELECT doc_id, pos, para FROM p1")
def paragraph_split(spark, sf):
    return ch.paragraph_rows(_docs(spark, sf), "text", ["doc_id"], sep=SEP)


@register("drop_toc_keywords", "WITH " + PARAS_SQL
          + f"\nSELECT doc_id, pos FROM p1 WHERE NOT regexp_matches(lower(para), {TOC_KEY_SQL})")
def drop_toc_keywords(spark, sf):
    p = ch.paragraph_rows(_docs(spark, sf), "text", ["doc_id"], sep=SEP)
    return p.where(~tx.is_toc_keyword(F.col("para"))).select("doc_id", "pos")


@register("drop_toc_lines", "WITH " + PARAS_SQL
          + f"\nSELECT doc_id, pos FROM p1 WHERE NOT regexp_matches(para, {TOC_LINE_SQL})")
def drop_toc_lines(spark, sf):
    p = ch.paragraph_rows(_docs(spark, sf), "text", ["doc_id"], sep=SEP)
    return p.where(~tx.is_toc_line(F.col("para"))).select("doc_id", "pos")


@register("drop_short", "WITH " + PARAS_SQL + "\nSELECT doc_id, pos FROM p1 WHERE length(para) >= 50")
def drop_short(spark, sf):
    p = ch.paragraph_rows(_docs(spark, sf), "text", ["doc_id"], sep=SEP)
    return p.where(~tx.is_short(F.col("para"))).select("doc_id", "pos")


@register("filter_paragraphs", "WITH " + FILTERED_SQL + "\nSELECT doc_id, pos, para FROM f1")
def filter_paragraphs(spark, sf):
    d = _docs(spark, sf)
    return ch.paragraph_rows(d, "text", ["doc_id"], paras=tx.filter_paragraphs(F.col("text"), SEP))


@register("token_count", "WITH " + FILTERED_SQL
          + f"\nSELECT doc_id, pos, len(regexp_extract_all(para, {TOKEN_SQL})) AS n_tokens FROM f1")
def token_count(spark, sf):
    d = _docs(spark, sf)
    p = ch.paragraph_rows(d, "text", ["doc_id"], paras=tx.filter_paragraphs(F.col("text"), SEP))
    return p.select("doc_id", "pos", tx.regex_token_count(F.col("para")).alias("n_tokens"))


def _windows_sql(src: str, size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
w0 AS (SELECT *, regexp_extract_all(para, {TOKEN_WS_SQL}) AS toks FROM {src}),
w1 AS (SELECT *, list_filter(range(0, len(toks), {step}), lambda s: s = 0 OR s + {overlap} < len(toks)) AS starts FROM w0),
w2 AS (SELECT *, unnest(starts) AS s, generate_subscripts(starts, 1) - 1 AS w_idx FROM w1),
w3 AS (SELECT *, rtrim(array_to_string(list_slice(toks, s + 1, s + {size}), ''), {WS_SQL}) AS content FROM w2)"""


@register("token_windows", "WITH " + FILTERED_SQL + f""",
lp AS (SELECT * FROM f1 WHERE len(regexp_extract_all(para, {TOKEN_SQL})) > {MAXTOK}),"""
          + _windows_sql("lp", MAXTOK, OVERLAP)
          + "\nSELECT doc_id, pos, w_idx, content FROM w3")
def token_windows(spark, sf):
    d = _docs(spark, sf)
    p = ch.paragraph_rows(d, "text", ["doc_id"], paras=tx.filter_paragraphs(F.col("text"), SEP))
    lp = p.where(tx.regex_token_count(F.col("para")) > MAXTOK)
    return lp.select("doc_id", "pos", F.posexplode(ch.token_windows(F.col("para"), MAXTOK, OVERLAP))
                     .alias("w_idx", "content"))


def chunks_ctes(max_tokens: int, ratio: float, where: str = "TRUE") -> str:
    """``WITH RECURSIVE ...`` ending in CTE ``chunks(doc_id, chunk_index,
    content)`` over the documents passing ``where``; callers add CTEs and
    the final SELECT."""
    overlap = int(max_tokens * ratio)
    m = max_tokens
    filtered = FILTERED_SQL.replace("FROM documents),\nf1", f"FROM documents WHERE {where}),\nf1")
    return "WITH RECURSIVE " + filtered + f""",
pn AS (SELECT doc_id, pos, para, len(regexp_extract_all(para, {TOKEN_SQL})) AS ntok FROM f1),
rec AS (
  SELECT doc_id, pos, 0 AS g, CASE WHEN ntok > {m} THEN 0 ELSE ntok END AS cur, ntok <= {m} AS open
  FROM pn WHERE pos = 0
  UNION ALL
  SELECT pn.doc_id, pn.pos,
         CASE WHEN rec.open AND rec.cur + pn.ntok <= {m} THEN rec.g ELSE rec.g + 1 END,
         CASE WHEN pn.ntok > {m} THEN 0 WHEN rec.open AND rec.cur + pn.ntok <= {m} THEN rec.cur + pn.ntok
              ELSE pn.ntok END,
         pn.ntok <= {m}
  FROM rec JOIN pn ON pn.doc_id = rec.doc_id AND pn.pos = rec.pos + 1),
grp AS (SELECT rec.doc_id, rec.g, string_agg(pn.para, chr(10) || chr(10) ORDER BY pn.pos) AS txt,
               max(pn.ntok) AS mx, min(pn.para) AS para
        FROM rec JOIN pn ON pn.doc_id = rec.doc_id AND pn.pos = rec.pos GROUP BY rec.doc_id, rec.g),
lg AS (SELECT doc_id, g, para FROM grp WHERE mx > {m}),""" + _windows_sql("lg", m, overlap) + f""",
allc AS (SELECT doc_id, g, 0 AS w_idx, txt AS content FROM grp WHERE mx <= {m}
         UNION ALL SELECT doc_id, g, w_idx, content FROM w3),
chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g, w_idx) - 1 AS chunk_index,
                  replace(content, chr(0), '') AS content FROM allc)"""


def _chunks_sql(max_tokens: int, ratio: float) -> str:
    return chunks_ctes(max_tokens, ratio) + "\nSELECT doc_id, chunk_index, content FROM chunks"


@register("pack_paragraphs", _chunks_sql(512, 0.25))
def pack_paragraphs(spark, sf):
    return ch.hierarchical_chunks(_docs(spark, sf), "text", ["doc_id"], sep=SEP, max_tokens=512,
                                  overlap_ratio=0.25)


@register("hierarchical_chunks", _chunks_sql(MAXTOK, RATIO))
def hierarchical_chunks(spark, sf):
    return ch.hierarchical_chunks(_docs(spark, sf), "text", ["doc_id"], sep=SEP,
                                  max_tokens=MAXTOK, overlap_ratio=RATIO)


@register("strip_nul", "SELECT doc_id, length(replace(text, chr(0), '')) AS n_chars_clean FROM documents")
def strip_nul(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.length(tx.strip_nul(F.col("text"))).alias("n_chars_clean"))


@register("heading_sections", "WITH " + PARAS_SQL + f"""
SELECT doc_id, pos,
       last_value(CASE WHEN regexp_matches(para, {q(ch.HEADING_RE)}) THEN para END IGNORE NULLS)
         OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
FROM p1""")
def heading_sections(spark, sf):
    d = _docs(spark, sf)
    paras = tx.paragraphs(F.col("text"), SEP)
    x = d.select("doc_id", F.arrays_zip(paras.alias("para"),
                                        ch.heading_sections(paras).alias("section")).alias("z"))
    return x.select("doc_id", F.posexplode("z").alias("pos", "e")).select(
        "doc_id", "pos", F.col("e.section").alias("section"))


# The documents hold no contents heading, numbered heading or NUL: the rules for
# those run on the documents with such lines added, the same on both sides.
MARKED_SQL = """
marked AS (SELECT doc_id, CASE doc_id % 5
  WHEN 0 THEN text || chr(10) || 'Table of Contents' || chr(10) || 'Table of contents and more words after it'
  WHEN 1 THEN '1.2 Title text 15' || chr(10) || text || chr(10) || '3 A 4'
  WHEN 2 THEN text || chr(10) || '1.2 Heading of a part' || chr(10) || 'Its body' || chr(10) || '2 Next'
  WHEN 3 THEN chr(0) || text || 'x' || chr(0)
  ELSE text END AS text FROM documents),"""


def _marked(spark, sf):
    d, t, k = _docs(spark, sf), F.col("text"), F.pmod(F.col("doc_id"), F.lit(5))
    text = (F.when(k == 0, F.concat(t, F.lit("\nTable of Contents\nTable of contents and more words after it")))
             .when(k == 1, F.concat(F.lit("1.2 Title text 15\n"), t, F.lit("\n3 A 4")))
             .when(k == 2, F.concat(t, F.lit("\n1.2 Heading of a part\nIts body\n2 Next")))
             .when(k == 3, F.concat(F.lit("\0"), t, F.lit("x\0"))).otherwise(t))
    return d.select("doc_id", text.alias("text"))


def _of_marked(sql: str) -> str:
    return MARKED_SQL + sql.replace("FROM documents", "FROM marked")


@register("drop_toc_keywords_marked", "WITH " + _of_marked(PARAS_SQL)
          + f"\nSELECT doc_id, pos FROM p1 WHERE NOT regexp_matches(lower(para), {TOC_KEY_SQL})")
def drop_toc_keywords_marked(spark, sf):
    p = ch.paragraph_rows(_marked(spark, sf), "text", ["doc_id"], sep=SEP)
    return p.where(~tx.is_toc_keyword(F.col("para"))).select("doc_id", "pos")


@register("drop_toc_lines_marked", "WITH " + _of_marked(PARAS_SQL)
          + f"\nSELECT doc_id, pos FROM p1 WHERE NOT regexp_matches(para, {TOC_LINE_SQL})")
def drop_toc_lines_marked(spark, sf):
    p = ch.paragraph_rows(_marked(spark, sf), "text", ["doc_id"], sep=SEP)
    return p.where(~tx.is_toc_line(F.col("para"))).select("doc_id", "pos")


@register("filter_paragraphs_marked", "WITH " + _of_marked(FILTERED_SQL)
          + "\nSELECT doc_id, pos, para FROM f1")
def filter_paragraphs_marked(spark, sf):
    return ch.paragraph_rows(_marked(spark, sf), "text", ["doc_id"],
                             paras=tx.filter_paragraphs(F.col("text"), SEP))


@register("strip_nul_marked", "WITH " + MARKED_SQL + """
c AS (SELECT doc_id, length(text) AS n FROM marked)
SELECT doc_id, length(replace(text, chr(0), '')) AS n_clean, c.n FROM marked JOIN c USING (doc_id)""")
def strip_nul_marked(spark, sf):
    t = F.col("text")
    return _marked(spark, sf).select("doc_id", F.length(tx.strip_nul(t)).alias("n_clean"), F.length(t).alias("n"))


@register("heading_sections_marked", "WITH " + _of_marked(PARAS_SQL) + f"""
SELECT doc_id, pos,
       last_value(CASE WHEN regexp_matches(para, {q(ch.HEADING_RE)}) THEN para END IGNORE NULLS)
         OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
FROM p1""")
def heading_sections_marked(spark, sf):
    paras = tx.paragraphs(F.col("text"), SEP)
    x = _marked(spark, sf).select("doc_id", F.arrays_zip(
        paras.alias("para"), ch.heading_sections(paras).alias("section")).alias("z"))
    return x.select("doc_id", F.posexplode("z").alias("pos", "e")).select(
        "doc_id", "pos", F.col("e.section").alias("section"))


@register("char_windows", """
WITH c AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
s AS (SELECT doc_id, text, unnest(list_filter(range(0, n, 324), lambda s: s = 0 OR s + 700 < n)) AS st FROM c)
SELECT doc_id, st AS start, md5(substring(text, st + 1, 1024)) AS h FROM s""")
def char_windows(spark, sf):
    d = _docs(spark, sf)
    w = d.select("doc_id", F.posexplode(ch.char_windows(F.col("text"), 1024, 700)).alias("i", "w"))
    return w.select("doc_id", (F.col("i") * 324).alias("start"), F.md5("w").alias("h"))
