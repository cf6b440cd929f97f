"""String column builders: whitespace, paragraphs, tokens.

The regular expressions are written in the subset shared by Java's regex and
RE2, so the same pattern text also serves the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config

# Characters that count as white space for a paragraph strip; the same set
# as str.isspace() in Python.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")
WS_CLASS = (r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_CLASS}]"

# Word characters for word bounds: letters, digits, underscore.
WORDCH = r"[\p{L}\p{N}_]"
NONWORDCH = r"[^\p{L}\p{N}_]"

# FIXED: contents-heading words, tested at word bounds on the lower-cased
# paragraph.
TOC_WORDS = r"sum[aá]rio|índice|table of contents|contents?"
TOC_KEYWORD_RE = f"(^|{NONWORDCH})({TOC_WORDS})($|{NONWORDCH})"
# FIXED: a numbered contents line ("1.2 Title 15"), anchored at the start.
TOC_LINE_RE = rf"^\p{{Nd}}+(?:\.\p{{Nd}}+)*{WS}+.+{WS}+\p{{Nd}}+$"

# Default tokenizer: runs of letters/digits, or any single other visible char.
TOKEN_RE = rf"[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WS_CLASS}]"
# Same tokens, each with the white space that follows it (windows keep the
# original spacing when the tokens are concatenated back).
TOKEN_WS_RE = rf"(?:[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WS_CLASS}]){WS}*"
# Words for the text vector (lower-cased first).
WORD_RE = r"[\p{L}\p{N}]+"


def literal_regex(s: str) -> str:
    """A regex matching the literal string ``s`` (Java and RE2)."""
    return "".join(f"\\x{{{ord(ch):x}}}" for ch in s)


def ustrip(c: Column) -> Column:
    """Strip leading and trailing white space (Python ``str.strip``)."""
    return F.trim(c, F.lit(WS_CHARS))


def rstrip_ws(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def paragraphs(text: Column, sep: str = config.PARAGRAPH_SEPARATOR) -> Column:
    """Split on a literal separator, strip each piece, drop empty ones."""
    parts = F.split(F.coalesce(text, F.lit("")), literal_regex(sep), -1)
    return F.filter(F.transform(parts, ustrip), lambda p: p != F.lit(""))


def is_toc_keyword(p: Column) -> Column:
    """Contents-heading word anywhere in the paragraph."""
    return F.lower(p).rlike(TOC_KEYWORD_RE)


def is_toc_line(p: Column) -> Column:
    """Numbered contents line. ``(?d)``: only ``\\n`` ends a line."""
    return p.rlike("(?d)" + TOC_LINE_RE)


def is_short(p: Column, min_chars: int = config.MIN_PARAGRAPH_CHARS) -> Column:
    """T4: shorter than ``min_chars`` code points."""
    return F.length(p) < F.lit(min_chars)


def keep_paragraph(p: Column, min_chars: int = config.MIN_PARAGRAPH_CHARS) -> Column:
    return ~is_toc_keyword(p) & ~is_toc_line(p) & ~is_short(p, min_chars)


def filter_paragraphs(text: Column, sep: str = config.PARAGRAPH_SEPARATOR,
                      min_chars: int = config.MIN_PARAGRAPH_CHARS) -> Column:
    """T5: T1 then T2-T4 in one higher-order ``filter``; order kept."""
    return F.filter(paragraphs(text, sep), lambda p: keep_paragraph(p, min_chars))


def regex_tokens(p: Column) -> Column:
    """Default tokenizer (T6): array of tokens."""
    return F.regexp_extract_all(p, F.lit(TOKEN_RE), 0)


def regex_token_count(p: Column) -> Column:
    return F.size(regex_tokens(p))


def strip_nul(c: Column) -> Column:
    """Remove U+0000."""
    return F.replace(c, F.lit("\x00"), F.lit(""))
