"""Paragraph filtering and token-bounded chunking.

Everything runs inside the row of its document with higher-order functions:
no shuffle, no Python. The greedy packing is a fold over the paragraph token
counts that assigns a group number to each paragraph (``util.scan``); the chunk
texts are then sliced out of the paragraph array group by group. With a
model's own tokenizer, ``tokenizer_chunks`` does the same over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import config
from quarry.functions import text as tx
from quarry.functions.util import let, scan

TokenCounter = Callable[[Column], Column]


def token_limit(model=None, tokenizer=None, default: int = config.MAX_TOKENS) -> int:
    """The chunk size of a plug-in model, decided once on the driver:
    the model's ``max_seq_length``, else its tokenizer's
    ``model_max_length``, else ``default``."""
    n = getattr(model, "max_seq_length", None) if model is not None else None
    if not n:
        tok = tokenizer if tokenizer is not None else getattr(model, "tokenizer", None)
        n = getattr(tok, "model_max_length", None) if tok is not None else None
    return int(n) if n else int(default)


def group_ids(ntoks: Column, max_tokens: int) -> Column:
    """T8's decisions: group number of each paragraph. A paragraph joins the
    open group while the group's count plus its own stays within the limit;
    a paragraph over the limit gets a group of its own and closes it."""
    m = F.lit(int(max_tokens))
    init = F.struct(F.lit(-1).alias("g"), F.lit(0).alias("cur"), F.lit(False).alias("open"))

    def step(st, n):
        long = n > m
        fits = st["open"] & (st["cur"] + n <= m)
        g2 = F.when(fits, st["g"]).otherwise(st["g"] + 1)
        cur2 = F.when(long, F.lit(0)).when(fits, st["cur"] + n).otherwise(n)
        return F.struct(g2.alias("g"), cur2.alias("cur"), (~long).alias("open")), g2
    return scan(ntoks, init, step, "int")


def token_windows(p: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` tokens starting every ``size - overlap`` tokens,
    stopping after the first window that reaches the end. Each window is the
    original text from its first token to its last."""
    step = int(size) - int(overlap)
    if step <= 0:
        raise ValueError("overlap must be smaller than the window")

    def body(s):
        n = F.size(s.toks)
        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)),
                          lambda st: (st == 0) | (st + int(overlap) < n))
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(
            F.transform(starts, lambda st: tx.rstrip_ws(
                F.array_join(F.slice(s.toks, st + 1, F.lit(int(size))), ""))))
    return let({"toks": F.regexp_extract_all(p, F.lit(tx.TOKEN_WS_RE), 0)}, body)


def pack_chunks(paras: Column, max_tokens: int = config.MAX_TOKENS,
                overlap_ratio: float = config.WINDOW_OVERLAP_RATIO,
                token_count: TokenCounter = tx.regex_token_count,
                joiner: str = config.CHUNK_JOINER) -> Column:
    """T8 + T9: ``ARRAY<STRING>`` of chunks of one document, in order."""
    overlap = int(max_tokens * overlap_ratio)

    def outer(s):
        nparas = F.size(s.p)

        def with_groups(t):
            idx = F.sequence(F.lit(0), F.greatest(nparas - 1, F.lit(0)))
            starts = F.filter(idx, lambda i: F.when(i == 0, F.lit(True))
                               .otherwise(t.g[i] != t.g[i - 1]))

            def per_group(u):
                ng = F.size(u.st)

                def chunk(k):
                    st = u.st[k]
                    en = F.when(k + 1 < ng, u.st[k + 1]).otherwise(nparas)
                    return F.when(s.n[st] > int(max_tokens),
                                  token_windows(s.p[st], max_tokens, overlap)) \
                        .otherwise(F.array(F.array_join(F.slice(s.p, st + 1, en - st), joiner)))
                return F.flatten(F.transform(F.sequence(F.lit(0), ng - 1), chunk))
            return let({"st": starts}, per_group)
        return F.when(nparas == 0, F.array().cast("array<string>")).otherwise(
            let({"g": group_ids(s.n, max_tokens)}, with_groups))
    # the paragraphs are bound before they are counted: they are filtered once
    return let({"p": paras}, lambda b: let({"p": b.p, "n": F.transform(b.p, token_count)}, outer))


Offsets = Callable[[str], list[tuple[int, int]]]


def tokenizer_chunks(load: Callable[[], Offsets], max_tokens: int = config.MAX_TOKENS,
                     overlap_ratio: float = config.WINDOW_OVERLAP_RATIO,
                     joiner: str = config.CHUNK_JOINER) -> Callable[[Column], Column]:
    """T6 + T8 + T9 in a model's own tokens: a function from paragraphs
    (``ARRAY<STRING>``) to chunks. ``load()`` runs once per Python worker and
    returns ``offsets(text)``, the (start, end) of each token. Paragraphs are
    counted once; one over the limit is cut into windows at its own token
    bounds, so no window holds more than ``max_tokens`` of its tokens."""
    size = int(max_tokens)
    step = size - int(size * overlap_ratio)
    if step <= 0:
        raise ValueError("overlap must be smaller than the window")

    def of(paras, offsets):
        out, held, room = [], [], 0
        for p in paras:
            spans = offsets(p)
            n = len(spans)
            if held and (n > size or n > room):
                out.append(joiner.join(held))
                held = []
            if n > size:
                for at in range(0, n, step):
                    window = spans[at:at + size]
                    out.append(p[window[0][0]:window[-1][1]])
                    if at + size >= n:
                        break
                continue
            room = (room if held else size) - n
            held.append(p)
        return out + [joiner.join(held)] if held else out

    @F.pandas_udf("array<string>")
    def chunks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        offsets = load()
        for b in batches:
            yield b.map(lambda paras: None if paras is None else of(paras, offsets))
    return chunks


def document_chunks(text: Column, sep: str = config.PARAGRAPH_SEPARATOR,
                    max_tokens: int = config.MAX_TOKENS,
                    overlap_ratio: float = config.WINDOW_OVERLAP_RATIO,
                    min_chars: int = config.MIN_PARAGRAPH_CHARS,
                    token_count: TokenCounter = tx.regex_token_count,
                    chunker: Callable[[Column], Column] | None = None) -> Column:
    """T5 -> T6 -> T8/T9 for one text; ``chunker`` (``tokenizer_chunks``) packs
    in a model's tokens instead."""
    if chunker is not None:
        return chunker(tx.filter_paragraphs(text, sep, min_chars))
    return pack_chunks(tx.filter_paragraphs(text, sep, min_chars), max_tokens, overlap_ratio,
                       token_count)


def hierarchical_chunks(df: DataFrame, text_col: str, keys: list[str],
                        sep: str = config.PARAGRAPH_SEPARATOR,
                        max_tokens: int = config.MAX_TOKENS,
                        overlap_ratio: float = config.WINDOW_OVERLAP_RATIO,
                        min_chars: int = config.MIN_PARAGRAPH_CHARS,
                        token_count: TokenCounter = tx.regex_token_count,
                        strip_nul: bool = True,
                        chunker: Callable[[Column], Column] | None = None) -> DataFrame:
    """T10 (+ T11): one row per chunk, ``chunk_index`` from 0 per document."""
    chunks = document_chunks(F.col(text_col), sep, max_tokens, overlap_ratio, min_chars,
                             token_count, chunker)
    out = df.select(*keys, F.posexplode(chunks).alias("chunk_index", "content"))
    if strip_nul:
        out = out.withColumn("content", tx.strip_nul(F.col("content")))
    return out


def paragraph_rows(df: DataFrame, text_col: str, keys: list[str],
                   paras: Column | None = None, sep: str = config.PARAGRAPH_SEPARATOR) -> DataFrame:
    """One row per paragraph with its position (from 0)."""
    paras = tx.paragraphs(F.col(text_col), sep) if paras is None else paras
    return df.select(*keys, F.posexplode(paras).alias("pos", "para"))


# FIXED: a heading starts with a section number ("1.2 Title").
HEADING_RE = rf"^\p{{Nd}}+(?:\.\p{{Nd}}+)*\.?{tx.WS}+\p{{Lu}}"


def heading_sections(paras: Column) -> Column:
    """For each paragraph, the last heading at or before it (or NULL),
    by a fold inside the row (no window, no shuffle)."""
    init = F.struct(F.lit(None).cast("string").alias("h"))

    def step(st, p):
        h = F.when(p.rlike(HEADING_RE), p).otherwise(st["h"])
        return F.struct(h.alias("h")), h
    return scan(paras, init, step, "string")


def char_windows(text: Column, size: int, overlap: int) -> Column:
    """Character windows of ``size`` starting every ``size - overlap``."""
    step = int(size) - int(overlap)
    if step <= 0:
        raise ValueError("overlap must be smaller than the window")
    n = F.length(text)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)),
                      lambda st: (st == 0) | (st + int(overlap) < n))
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda st: text.substr(st + 1, F.lit(int(size)))))
