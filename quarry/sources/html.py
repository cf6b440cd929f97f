"""Text extractors for raw web pages (S7), the extraction cascade (S5, S6,
S8), extracted records and the minimum-text gate (S9, S10).

The extractors are ``regexp_replace`` chains: native, per row, no Python.
Binary formats (PDF, Word, images) enter through ``binary_extractor``, an
Arrow hook whose body the user supplies.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import text as tx
from quarry.functions.util import let
from quarry.session import cut_lineage

# Patterns shared with the SQL oracle (Java regex and RE2 agree on these).
SCRIPT_RE = r"(?is)<script\b.*?</script>"
STYLE_RE = r"(?is)<style\b.*?</style>"
COMMENT_RE = r"(?s)<!--.*?-->"
BR_RE = r"(?i)<br\s*/?>"
BLOCK_END_RE = r"(?i)</(p|div|h[1-6]|li|tr|article|section|header|footer|nav|ul|ol|table|title)>"
TAG_RE = r"<[^>]*>"
HSPACE_RE = r"[ \t\x{a0}]+"
LINE_EDGE_RE = r"(?m)^ +| +$"
BLANKS_RE = r"\n{3,}"
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
LANG_RE = r"(?i)<html[^>]*\slang=\"([^\"]*)\""
ARTICLE_RE = r"(?is)<article[^>]*>(.*?)</article>"
ARTICLE_OPEN_RE = r"(?i)<article[\s>]"
LI_RE = r"(?i)<li[^>]*>"

# FIXED: the entities decoded, in this order (ampersand last).
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&amp;", "&"))


def unescape(c: Column) -> Column:
    for k, v in ENTITIES:
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def _drop_invisible(html: Column) -> Column:
    c = F.regexp_replace(html, SCRIPT_RE, " ")
    c = F.regexp_replace(c, STYLE_RE, " ")
    return F.regexp_replace(c, COMMENT_RE, " ")


def _finish(c: Column) -> Column:
    c = F.regexp_replace(c, TAG_RE, "")
    c = unescape(c)
    c = F.regexp_replace(c, HSPACE_RE, " ")
    c = F.regexp_replace(c, "(?d)" + LINE_EDGE_RE, "")
    c = F.regexp_replace(c, BLANKS_RE, "\n\n")
    return tx.ustrip(c)


def html_to_text(html: Column) -> Column:
    """S7 (a): flat text; block ends become line breaks."""
    c = _drop_invisible(html)
    c = F.regexp_replace(c, BR_RE, "\n")
    c = F.regexp_replace(c, BLOCK_END_RE, "\n")
    return _finish(c)


def html_to_markdown(html: Column) -> Column:
    """S7 (b): keeps headings as ``#`` lines and list items as ``-`` lines."""
    c = _drop_invisible(html)
    for level in range(6, 0, -1):
        c = F.regexp_replace(c, rf"(?is)<h{level}[^>]*>(.*?)</h{level}>",
                             "\n" + "#" * level + " $1\n")
    c = F.regexp_replace(c, LI_RE, "\n- ")
    c = F.regexp_replace(c, BR_RE, "\n")
    c = F.regexp_replace(c, BLOCK_END_RE, "\n")
    return _finish(c)


def title(html: Column) -> Column:
    return tx.ustrip(unescape(F.regexp_extract(html, TITLE_RE, 1)))


def article_text(html: Column) -> Column:
    """The texts of all articles of a page, in order."""
    return html_to_text(F.array_join(F.regexp_extract_all(html, F.lit(ARTICLE_RE), 1), "\n"))


# Strategy registry, name -> extractor over the raw page.
STRATEGIES: dict[str, Callable[[Column], Column]] = {
    "text": html_to_text,
    "markdown": html_to_markdown,
    "article": article_text,
    "title": title,
}


def strategy(name: str) -> Callable[[Column], Column]:
    """Unknown names give an empty text, so the fallbacks run."""
    return STRATEGIES.get(name, lambda html: F.lit(""))


def passes(c: Column, threshold: int = config.OCR_THRESHOLD) -> Column:
    return F.coalesce(F.length(tx.ustrip(c)) > F.lit(int(threshold)), F.lit(False))


def cascade(primary: Column, fallbacks: list[Column], last: Column,
            threshold: int = config.OCR_THRESHOLD) -> tuple[Column, Column]:
    """(text, index of the winner). The primary wins if its trimmed
    length is over the threshold; else the first fallback that passes (NULL
    = the extractor failed); else the last resort unconditionally; if that
    failed too, the primary's own result. ``coalesce`` and ``when`` evaluate
    lazily, so a later extractor only runs for rows still without a winner."""
    def winner(c: Column, i: int) -> Column:
        return let({"c": c}, lambda s: F.when(passes(s.c, threshold), F.struct(
            s.c.alias("text"), F.lit(i).alias("idx"))))

    cands = [primary] + list(fallbacks)
    resort = let({"c": last}, lambda s: F.when(s.c.isNotNull(), F.struct(
        s.c.alias("text"), F.lit(len(cands)).alias("idx"))))
    won = F.coalesce(*[winner(c, i) for i, c in enumerate(cands)], resort,
                     F.struct(primary.alias("text"), F.lit(-1).alias("idx")))
    return won["text"], won["idx"]


def staged_cascade(df: DataFrame, key: str, extractors: list[Callable[[DataFrame], DataFrame]],
                   threshold: int = config.OCR_THRESHOLD) -> DataFrame:
    """S6 for costly extractors: stage n runs only on rows without a winner
    from stages before it (each extractor maps ``df`` to ``key, text``), and
    once: its rows are checkpointed. A row that no stage passes keeps the last
    stage's text, or the first stage's where that failed (stage -1)."""
    done, first, out, todo = None, None, None, df
    for i, ex in enumerate(extractors):
        out = cut_lineage(ex(todo).withColumn("stage", F.lit(i)))
        first = out if first is None else first
        won = out.where(passes(F.col("text"), threshold))
        done = won if done is None else done.unionByName(won)
        todo = todo.join(won.select(key), key, "left_anti")
    primary = first.select(key, F.col("text").alias("_primary"))
    rest = out.where(~passes(F.col("text"), threshold)).join(primary, key, "left")
    failed = F.col("text").isNull()
    return done.unionByName(rest.select(
        key, F.when(failed, F.col("_primary")).otherwise(F.col("text")).alias("text"),
        F.when(failed, F.lit(-1)).otherwise(F.col("stage")).alias("stage")))


def needs_ocr(direct_text: Column, threshold: int = config.OCR_THRESHOLD) -> Column:
    """The direct text is not long enough; the image path is needed."""
    return ~passes(direct_text, threshold)


def build_record(text: Column, info: Column) -> Column:
    """``struct(text, info, version)``; ``info`` empty when missing."""
    return F.struct(text.alias("text"),
                    (F.create_map().cast("map<string,string>") if info is None else info).alias("info"),
                    F.lit(config.RECORD_VERSION).alias("version"))


def page_info(html: Column, url: Column) -> Column:
    """Properties of a page: title, language, address and the number of
    articles in it (standing for the page count)."""
    return F.struct(title(html).alias("title"),
                    F.regexp_extract(html, LANG_RE, 1).alias("lang"),
                    url.alias("url"),
                    F.size(F.regexp_extract_all(html, F.lit(ARTICLE_OPEN_RE), 0)).alias("numpages"))


def text_gate(text: Column, threshold: int = config.OCR_THRESHOLD) -> Column:
    """S10: 'error' when the text is empty or its trimmed length is under the
    threshold (exactly the threshold is accepted), else 'ok'."""
    n = F.length(tx.ustrip(F.coalesce(text, F.lit(""))))
    return F.when(n < F.lit(int(threshold)), F.lit("error")).otherwise(F.lit("ok"))


def binary_extractor(df: DataFrame, decode: Callable[[bytes, str], str],
                     path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Arrow hook for binary documents (``binaryFile`` rows): ``decode(bytes,
    path) -> text`` is the user's codec, run once per file inside the task.
    A failing file gives NULL (a miss for the cascade), not a failed job."""
    def run(batches):
        for pdf in batches:
            out = []
            for b, p in zip(pdf[content_col], pdf[path_col]):
                try:
                    out.append(decode(bytes(b), p))
                except Exception:  # noqa: BLE001 - one bad file must not stop the run
                    out.append(None)
            yield pd.DataFrame({path_col: pdf[path_col], "text": out})
    return df.select(path_col, content_col).mapInPandas(run, f"{path_col} string, text string")
