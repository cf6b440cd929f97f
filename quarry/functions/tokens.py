"""Token classes of a text (L1) and dictionaries by class (L2).

The scanner is one regular expression whose alternatives are tried in order at
each place, then a step that takes compound tokens apart. Classes and what they
look like (letters are Unicode letters unless said otherwise):

    email          a@b.c
    url            host and path; preceded by protocol where the text has one
    host           labels joined by dots, the last one of letters
    url_path       the path of a url
    version        digits joined by two dots or more
    float, uint    numbers; a float may have a sign
    asciihword     words joined by hyphens, all ASCII letters
    hword          the same with other letters; numhword with digits (dates too)
    hword_asciipart, hword_part, hword_numpart   the parts of these
    asciiword      ASCII letters
    word           letters, not all ASCII
    numword        letters and digits

A compound token stands before its parts (url before host and url_path), and
every token has a position of its own, from 1. All is native: one
``regexp_extract_all`` and one ``transform`` over its tokens, linear in the text.

``lexemes`` maps tokens by class: the ASCII word classes to a dictionary, every
other class to its lower case, as the search configuration does. The distinct
(class, token) pairs of a corpus are mapped once (``vocabulary``) and joined."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions.util import let
from quarry.session import scratch_path

_L = r"\p{L}"
_LN = r"[\p{L}\p{N}]"
# the published limits of names: labels of 63 characters, 127 of them, local
# parts of 64; they also bound what is tried at one place
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?"
_HOST = rf"{_LABEL}(?:\.{_LABEL}){{0,125}}\.[\p{{L}}]{{2,63}}"
_PATH = r"/[\p{L}\p{N}._~%&=?#+:;,@!$/-]*"

#: Alternatives in the order in which they are tried. ``++`` keeps the JVM's
#: engine from recursing; a single ``+`` means the same here.
PATTERNS = {
    "email": rf"[\p{{L}}\p{{N}}_+-][\p{{L}}\p{{N}}._+-]{{0,63}}@{_HOST}",
    "protocol": r"[A-Za-z][A-Za-z0-9+]{0,31}://",
    "url": _HOST + _PATH,
    "host": _HOST,
    "version": r"[0-9]+(?:\.[0-9]+){2,20}",
    "float": r"[+-]?[0-9]+\.[0-9]+",
    "numhword": rf"{_LN}++(?:-{_LN}++)++",
    "numword": rf"{_LN}++",
}
TOKEN_RE = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What the JVM scans with finds the same tokens: a run of letters and digits that
# nothing compound can follow is taken first, the rest is tried only where the
# character it needs stands after the run, and runs give nothing back.
_SCAN = {
    "email": PATTERNS["email"].replace("{0,63}@", "{0,63}+@"),
    "protocol": PATTERNS["protocol"].replace("{0,31}:", "{0,31}+:"),
    "host": rf"(?=[\p{{L}}\p{{N}}-]++\.)(?:{PATTERNS['url']}|{PATTERNS['host']})",
    **{c: PATTERNS[c] for c in ("version", "float", "numhword", "numword")},
}
SCAN_RE = rf"{_LN}++(?![\p{{L}}\p{{N}}._+@:/-])|" + "|".join(f"(?:{p})" for p in _SCAN.values())
ASCII_CLASSES = ("asciiword", "asciihword", "hword_asciipart")
_TYPE = "array<struct<class:string,token:string>>"


def _full(token: Column, pattern: str) -> Column:
    return token.rlike(f"^(?:{pattern})$")


def token_class(token: Column) -> Column:
    """Class of a token that ``TOKEN_RE`` found."""
    words = _full(token, rf"{_L}+")
    hyphens = _full(token, rf"{_L}++(?:-{_L}++)++")
    return (F.when(_full(token, "[A-Za-z]+"), "asciiword").when(words, "word")
            .when(_full(token, "[0-9]+"), "uint")
            .when(_full(token, rf"{_LN}+"), "numword")
            .when(_full(token, r"[A-Za-z]++(?:-[A-Za-z]++)++"), "asciihword").when(hyphens, "hword")
            .when(_full(token, PATTERNS["email"]), "email")
            .when(_full(token, PATTERNS["protocol"]), "protocol")
            .when(_full(token, PATTERNS["version"]), "version")
            .when(_full(token, PATTERNS["float"]), "float")
            .when(_full(token, PATTERNS["url"]), "url")
            .when(_full(token, PATTERNS["host"]), "host")
            .otherwise("numhword"))


def _parts(t: Column) -> Column:
    """A classified token and its parts."""
    token, kind = t["token"], t["class"]

    def part(x):
        name = (F.when(_full(x, "[A-Za-z]+"), "hword_asciipart").when(_full(x, rf"{_L}+"), "hword_part")
                .otherwise("hword_numpart"))
        return F.struct(name.alias("class"), x.alias("token"))

    at = F.locate("/", token)
    pieces = (F.when(kind.isin("asciihword", "hword", "numhword"), F.transform(F.split(token, "-"), part).cast(_TYPE))
              .when(kind == "url", F.array(
                  F.struct(F.lit("host").alias("class"), F.substring(token, F.lit(1), at - 1).alias("token")),
                  F.struct(F.lit("url_path").alias("class"),
                           F.substring(token, at, F.length(token)).alias("token"))).cast(_TYPE))
              .otherwise(F.array().cast(_TYPE)))
    whole = F.array(F.struct(kind.alias("class"), token.alias("token"))).cast(_TYPE)
    return F.when(kind.isin("asciihword", "hword", "numhword", "url"), F.concat(whole, pieces)).otherwise(whole)


def _found(text: Column) -> Column:
    """What the scanner finds, compounds whole."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SCAN_RE), 0)


def scan(text: Column) -> Column:
    """All tokens of a text: array of (class, token), in order. Null is empty."""
    found = _found(text)
    return let({"t": F.transform(found, lambda x: F.struct(token_class(x).alias("class"), x.alias("token")))},
               lambda s: F.flatten(F.transform(s["t"], _parts)))


def occurrences(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, pos, class, token): every token but protocols, which have no lexeme."""
    rows = docs.select(key, F.filter(scan(F.col(text_col)), lambda t: t["class"] != "protocol").alias("t"))
    return rows.select(key, F.posexplode("t").alias("i", "t")).select(
        key, (F.col("i") + 1).alias("pos"), "t.class", "t.token")


def lexeme(kind: Column, token: Column, stem: Callable[[str], str]) -> Column:
    @F.pandas_udf("string")
    def stems(ws: pd.Series) -> pd.Series:
        return ws.map(stem, na_action="ignore")

    low = F.lower(token)
    return F.when(kind.isin(*ASCII_CLASSES), stems(low)).otherwise(low)


def vocabulary(docs: DataFrame, text_col: str, stem: Callable[[str], str] = ft.portuguese) -> DataFrame:
    """(class, token, lexeme) of the distinct tokens of ``docs``, written once: the
    dictionary sees a token once, however often it occurs. What the scanner finds
    is classified and taken apart once for the corpus; it is told apart within
    each row first, as strings."""
    found = docs.select(F.explode(F.array_distinct(_found(F.col(text_col)))).alias("x")).distinct()
    whole = F.struct(token_class(F.col("x")).alias("class"), F.col("x").alias("token"))
    found = found.select(F.explode(let({"t": whole}, lambda s: _parts(s["t"]))).alias("t")).select("t.class", "t.token")
    found = found.where(F.col("class") != "protocol").distinct()
    path = scratch_path(docs.sparkSession, "vocabulary")
    found.select("class", "token", lexeme(F.col("class"), F.col("token"), stem).alias("lexeme")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def lexemes(docs: DataFrame, key: str, text_col: str, stem: Callable[[str], str] = ft.portuguese) -> DataFrame:
    """(key, pos, class, token, lexeme) of every token, its lexeme joined from the
    vocabulary. A token is counted within its document before the join, so one
    that is in every text crosses the shuffle once a document."""
    words = vocabulary(docs, text_col, stem)
    held = (occurrences(docs, key, text_col).groupBy(key, "class", "token")
            .agg(F.sort_array(F.collect_list("pos")).alias("at")))
    return (held.join(words, ["class", "token"])
            .select(key, F.explode("at").alias("pos"), "class", "token", "lexeme"))
