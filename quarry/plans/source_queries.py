"""Registered source queries (S1-S15, A2) over ``documents`` paths and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import config
from quarry.functions import text as tx
from quarry.functions.util import spread
from quarry.plans.chunk_queries import WS_SQL
from quarry.plans.oracle_fulltext import q
from quarry.plans.registry import register
from quarry.sources import files, html
from quarry.sources.testdata import DOC_PATHS_SQL, PATH_ROOT, doc_paths

VALID_SQL = f"regexp_matches(lower(path), {q(files.VALID_RE)})"
IMAGE_SQL = f"regexp_matches(lower(path), {q(files.IMAGE_RE)})"
REL_SQL = f"CASE WHEN starts_with(path, '{PATH_ROOT}/') THEN substring(path, {len(PATH_ROOT) + 2}) ELSE path END"
INV_SQL = f"WITH p AS ({DOC_PATHS_SQL}) SELECT doc_id, path FROM p WHERE {VALID_SQL} AND NOT regexp_matches({REL_SQL}, {q(files.ARCHIVE_RE)})"


@register("file_inventory", INV_SQL)
def file_inventory(spark, sf):
    return files.inventory(doc_paths(spark, sf), PATH_ROOT)


@register("file_count", f"SELECT count(*) AS n_files FROM ({INV_SQL})")
def file_count(spark, sf):
    return files.inventory(doc_paths(spark, sf), PATH_ROOT).agg(F.count("*").alias("n_files"))


@register("valid_files", f"WITH p AS ({DOC_PATHS_SQL}) SELECT doc_id, {VALID_SQL} AS valid FROM p")
def valid_files(spark, sf):
    p = doc_paths(spark, sf)
    return p.select("doc_id", files.has_valid_ext(F.col("path")).alias("valid"))


@register("normalize_name", f"""WITH p AS ({DOC_PATHS_SQL})
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(trim(path, {WS_SQL}), '/(\\./)+', '/', 'g'),
       '/{{2,}}', '/', 'g'), {q(tx.WS + '+(\\.[^./]*)$')}, '\\1') AS path FROM p""")
def normalize_name(spark, sf):
    p = doc_paths(spark, sf)
    return p.select("doc_id", files.normalize_name(F.col("path")).alias("path"))


@register("extract_route", f"""WITH p AS ({DOC_PATHS_SQL})
SELECT doc_id, CASE WHEN {IMAGE_SQL} THEN 'image' WHEN ends_with(lower(path), '.docx') THEN 'unstructured'
                    ELSE 'ocr' END AS route FROM p""")
def extract_route(spark, sf):
    p = doc_paths(spark, sf)
    return p.select("doc_id", files.route(F.col("path"), "ocr").alias("route"))


@register("archive_names", f"""WITH p AS ({INV_SQL}),
b AS (SELECT doc_id, path, regexp_extract(path, '[^/]*$', 0) AS base FROM p),
e AS (SELECT *, regexp_extract(base, {q(files.EXT_RE)}, 1) AS ext,
             row_number() OVER (PARTITION BY base ORDER BY path) AS rn FROM b)
SELECT doc_id, path, '{PATH_ROOT}/Processado/' || CASE WHEN rn = 1 THEN base
       ELSE substring(base, 1, length(base) - length(ext)) || '_' || CAST(rn - 1 AS VARCHAR) || ext END AS target
FROM e""")
def archive_names(spark, sf):
    inv = files.inventory(doc_paths(spark, sf), PATH_ROOT)
    return files.archive_names(inv, PATH_ROOT + "/Processado").select("doc_id", "path", "target")


# --- pages ------------------------------------------------------------------
def _rx(pat: str, repl: str, expr: str) -> str:
    return f"regexp_replace({expr}, {q(pat)}, {q(repl)}, 'g')"


def _unescape_sql(expr: str) -> str:
    for k, v in html.ENTITIES:
        expr = f"replace({expr}, {q(k)}, {q(v)})"
    return expr


def _finish_sql(expr: str) -> str:
    e = _rx(html.TAG_RE, "", expr)
    e = _unescape_sql(e)
    e = _rx(html.HSPACE_RE, " ", e)
    e = _rx(html.LINE_EDGE_RE, "", e)
    e = _rx(html.BLANKS_RE, "\n\n", e)
    return f"trim({e}, {WS_SQL})"


def _invisible_sql(expr: str) -> str:
    return _rx(html.COMMENT_RE, " ", _rx(html.STYLE_RE, " ", _rx(html.SCRIPT_RE, " ", expr)))


def text_sql(expr: str) -> str:
    e = _invisible_sql(expr)
    e = _rx(html.BLOCK_END_RE, "\n", _rx(html.BR_RE, "\n", e))
    return _finish_sql(e)


def markdown_sql(expr: str) -> str:
    e = _invisible_sql(expr)
    for level in range(6, 0, -1):
        e = _rx(rf"(?is)<h{level}[^>]*>(.*?)</h{level}>", "\n" + "#" * level + " \\1\n", e)
    e = _rx(html.LI_RE, "\n- ", e)
    e = _rx(html.BLOCK_END_RE, "\n", _rx(html.BR_RE, "\n", e))
    return _finish_sql(e)


def title_sql(expr: str) -> str:
    return f"trim({_unescape_sql(f'regexp_extract({expr}, {q(html.TITLE_RE)}, 1)')}, {WS_SQL})"


def article_sql(expr: str) -> str:
    return text_sql(f"array_to_string(regexp_extract_all({expr}, {q(html.ARTICLE_RE)}, 1), chr(10))")


def _pages(spark, sf):
    return spread(spark.read.parquet(f"{sf}/pages.parquet"))


@register("html_to_text", f"SELECT page_id, {text_sql('html')} AS text FROM pages")
def html_to_text(spark, sf):
    return _pages(spark, sf).select("page_id", html.html_to_text(F.col("html")).alias("text"))


@register("html_to_markdown", f"SELECT page_id, {markdown_sql('html')} AS text FROM pages")
def html_to_markdown(spark, sf):
    return _pages(spark, sf).select("page_id", html.html_to_markdown(F.col("html")).alias("text"))


def _passes_sql(e: str) -> str:
    return f"coalesce(length(trim({e}, {WS_SQL})) > {config.OCR_THRESHOLD}, FALSE)"


@register("extract_cascade", f"""
WITH c AS (SELECT page_id, {title_sql('html')} AS c0, {article_sql('html')} AS c1,
                  {text_sql('html')} AS c2, {markdown_sql('html')} AS last FROM pages)
SELECT page_id,
       CASE WHEN {_passes_sql('c0')} THEN 0 WHEN {_passes_sql('c1')} THEN 1 WHEN {_passes_sql('c2')} THEN 2
            WHEN last IS NOT NULL THEN 3 ELSE -1 END AS winner,
       md5(coalesce(CASE WHEN {_passes_sql('c0')} THEN c0 END, CASE WHEN {_passes_sql('c1')} THEN c1 END,
                    CASE WHEN {_passes_sql('c2')} THEN c2 END, last, c0)) AS text_md5
FROM c""")
def extract_cascade(spark, sf):
    p = _pages(spark, sf)
    h = F.col("html")
    text, idx = html.cascade(html.strategy("title")(h),
                             [html.strategy("article")(h), html.strategy("text")(h)],
                             html.strategy("markdown")(h))
    return p.select("page_id", idx.alias("winner"), F.md5(text).alias("text_md5"))


@register("needs_ocr", f"SELECT doc_id, NOT {_passes_sql('text')} AS needs_ocr FROM documents")
def needs_ocr(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", html.needs_ocr(F.col("text")).alias("needs_ocr"))


@register("build_record", f"""
SELECT page_id, json_object('title', {title_sql('html')},
                            'lang', regexp_extract(html, {q(html.LANG_RE)}, 1), 'url', url,
                            'numpages', len(regexp_extract_all(html, {q(html.ARTICLE_OPEN_RE)})))::VARCHAR AS info,
       '{config.RECORD_VERSION}' AS version, length({text_sql('html')}) AS n_chars
FROM pages""")
def build_record(spark, sf):
    p = _pages(spark, sf)
    info = html.page_info(F.col("html"), F.col("url"))
    rec = html.build_record(html.html_to_text(F.col("html")), None)
    return p.select("page_id", F.to_json(info).alias("info"), rec.version.alias("version"),
                    F.length(rec.text).alias("n_chars"))


@register("min_text_gate", f"""
SELECT doc_id, CASE WHEN length(trim(coalesce(text, ''), {WS_SQL})) < {config.OCR_THRESHOLD} THEN 'error'
                    ELSE 'ok' END AS status FROM documents""")
def min_text_gate(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", html.text_gate(F.col("text")).alias("status"))
