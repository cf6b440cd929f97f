"""Full-text search as column expressions.

A text vector is ``ARRAY<STRUCT<lexeme STRING, pos INT, weight STRING>>``: one
entry per word occurrence, positions from 1; content words get weight A,
metadata words weight B with positions shifted past the content's last
position. Every occurrence counts; the position limits of some text-vector
stores are arguments, off by default.

A text query (websearch or phrase syntax) is parsed on the driver into a
small tree of literals and compiled into a predicate (``@@``) and a rank
(``ts_rank``) over the few query lexemes; nothing runs per row in Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config
from quarry.functions.stemmer import portuguese
from quarry.functions.text import WORD_RE
from quarry.functions.util import let

W_A = config.RANK_WEIGHTS["A"]
W_B = config.RANK_WEIGHTS["B"]
ZETA2 = 1.64493406685  # FIXED: normaliser of the occurrence sum (pi^2/6)

_PY_WORD = re.compile(r"[^\W_]+")
_LIGHT_STEM_RE = r"^([a-z]{3,}[^s])s$"


# --------------------------------------------------------------------------
# Dictionaries (L2)
# --------------------------------------------------------------------------
def ascii_stem(word: str) -> str:
    """ASCII words are stemmed; words of other letters, and tokens that are no
    words, are lexemes as they are."""
    return portuguese(word) if word.isascii() else word


# "portuguese" is the bare stemmer; "pt_en" the search configuration, which maps
# only the ASCII word classes to it
DICTIONARIES: dict[str, Callable[[str], str]] = {"portuguese": portuguese, "pt_en": ascii_stem}


def register_dictionary(name: str, stem: Callable[[str], str]) -> None:
    """Make ``stem`` (lower-cased word to lexeme) a dictionary for texts and
    queries alike."""
    DICTIONARIES[name] = stem


def _plugin(dictionary: str) -> Callable[[str], str]:
    if dictionary not in DICTIONARIES:
        raise ValueError(f"unknown dictionary {dictionary!r}")
    return DICTIONARIES[dictionary]


def apply_dictionary(w: Column, dictionary: str = "simple") -> Column:
    """Map a lower-cased word to its lexeme. ``simple``: the word itself.
    ``light``: ASCII words lose a plural ``s`` (a native stand-in for a
    stemmer; words with other characters are only lower-cased). Others
    (``portuguese``, registered ones) run over Arrow batches."""
    if dictionary == "simple":
        return w
    if dictionary == "light":
        return F.when(w.rlike("^[a-z]+$"), F.regexp_replace(w, _LIGHT_STEM_RE, "$1")).otherwise(w)
    stem = _plugin(dictionary)

    @F.pandas_udf("string")
    def lexeme(ws: pd.Series) -> pd.Series:
        return ws.map(stem, na_action="ignore")
    return lexeme(w)


def py_dictionary(w: str, dictionary: str = "simple") -> str:
    if dictionary == "simple":
        return w
    if dictionary == "light":
        return re.sub(_LIGHT_STEM_RE, r"\1", w) if re.fullmatch(r"[a-z]+", w) else w
    return _plugin(dictionary)(w)


def words(text: Column, dictionary: str = "simple") -> Column:
    """L1 + L2: lexemes of a text in order."""
    ws = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_RE), 0)
    if dictionary == "simple":
        return ws
    if dictionary == "light":
        return F.transform(ws, lambda w: apply_dictionary(w, dictionary))
    stem = _plugin(dictionary)

    @F.pandas_udf("array<string>")
    def lexemes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [stem(w) for w in t])
    return lexemes(ws)


def py_words(text: str, dictionary: str = "simple") -> list[str]:
    return [py_dictionary(w, dictionary) for w in _PY_WORD.findall(text.lower())]


# --------------------------------------------------------------------------
# Text vectors
# --------------------------------------------------------------------------
def _weighted(ws: Column, weight: str, shift: Column | None, max_pos: int | None) -> Column:
    def entry(w, i):
        p = i + 1 if shift is None else i + 1 + shift
        p = p if max_pos is None else F.least(p, F.lit(int(max_pos)))
        return F.struct(w.alias("lexeme"), p.cast("int").alias("pos"),
                        F.lit(weight).alias("weight"))
    return F.transform(ws, entry)


def text_vector(content: Column, meta_text: Column | None = None,
                dictionary: str = "simple", max_pos: int | None = None) -> Column:
    """A(content) || B(metadata text). The B positions are shifted by the
    largest A position (L4). ``max_pos`` clamps positions."""
    if meta_text is None:
        return _weighted(words(content, dictionary), "A", None, max_pos)

    def both(s):
        # the words are bound once: a shift that named the text itself would
        # split it again for every metadata word
        last = F.size(s.a) if max_pos is None else F.least(F.size(s.a), F.lit(int(max_pos)))
        return F.concat(_weighted(s.a, "A", None, max_pos), _weighted(s.b, "B", last, max_pos))
    return let({"a": words(content, dictionary), "b": words(meta_text, dictionary)}, both)


def lexeme_entries(tsv: Column, lexeme: str) -> Column:
    """Distinct positions of one lexeme as ``ARRAY<STRUCT<pos INT, w DOUBLE>>``,
    ascending."""
    return limit_entries(F.filter(tsv, lambda e: e.lexeme == F.lit(lexeme)))


def limit_entries(mine: Column, max_num: int | None = None) -> Column:
    """The occurrences of one lexeme (``pos``, ``weight``; ascending) as
    ``ARRAY<STRUCT<pos INT, w DOUBLE>>`` with distinct positions per weight, the
    first ``max_num`` of them if given."""
    def of(m, weight, w):
        ps = F.array_distinct(F.transform(F.filter(m.mine, lambda e: e.weight == weight),
                                          lambda e: e.pos))
        return F.transform(ps, lambda p: F.struct(p.alias("pos"), F.lit(w).alias("w")))

    def both(m):
        out = F.concat(of(m, "A", W_A), of(m, "B", W_B))
        return out if max_num is None else F.slice(out, 1, int(max_num))
    return let({"mine": mine}, both)


# --------------------------------------------------------------------------
# Text queries
# --------------------------------------------------------------------------
@dataclass
class Node:
    op: str                      # lex | and | or | not | phrase
    lexeme: str | None = None
    kids: list["Node"] = field(default_factory=list)

    def lexemes(self) -> list[str]:
        if self.op == "lex":
            return [self.lexeme]
        out = []
        for k in self.kids:
            out.extend(k.lexemes())
        return out


@dataclass
class TextQuery:
    """A parsed query: ``tree`` None means the query has no lexemes (matches
    nothing); ``raw`` is the original text (used by the substring test)."""
    raw: str
    tree: Node | None

    def distinct_lexemes(self) -> list[str]:
        if self.tree is None:
            return []
        return sorted(set(self.tree.lexemes()))


def _conj(nodes: list[Node], op: str) -> Node | None:
    nodes = [n for n in nodes if n is not None]
    if not nodes:
        return None
    if len(nodes) == 1:
        return nodes[0]
    return Node(op, kids=nodes)


def _phrase_of(ws: list[str]) -> Node | None:
    if not ws:
        return None
    if len(ws) == 1:
        return Node("lex", ws[0])
    return Node("phrase", kids=[Node("lex", w) for w in ws])


def phrase_query(text: str, dictionary: str = "simple") -> TextQuery:
    """``phraseto_tsquery``: all lexemes of the text in a row."""
    return TextQuery(text, _phrase_of(py_words(text, dictionary)))


def websearch_query(text: str, dictionary: str = "simple") -> TextQuery:
    """``websearch_to_tsquery``: bare words AND-ed (a word of several parts is
    their phrase), ``"..."`` a phrase, ``or``
    between operands an alternation (AND binds tighter), ``-`` a negation."""
    items: list = []          # Node or "or"
    i, n = 0, len(text)
    while i < n:
        ch = text[i]
        if ch.isspace():
            i += 1
            continue
        neg = False
        if ch == "-":
            neg = True
            i += 1
            if i >= n or text[i].isspace():
                continue
            ch = text[i]
        if ch == '"':
            j = text.find('"', i + 1)
            j = n if j < 0 else j
            node = _phrase_of(py_words(text[i + 1:j], dictionary))
            i = j + 1
        else:
            j = i
            while j < n and not text[j].isspace() and text[j] != '"':
                j += 1
            word = text[i:j]
            i = j
            if not neg and word.lower() == "or":
                items.append("or")
                continue
            node = _phrase_of(py_words(word, dictionary))  # a-b: its parts in a row
        if node is not None:
            items.append(Node("not", kids=[node]) if neg else node)
    # or-groups of and-ed operands; stray or's are dropped
    groups: list[list[Node]] = [[]]
    for it in items:
        if it == "or":
            if groups[-1]:
                groups.append([])
        else:
            groups[-1].append(it)
    ors = [_conj(g, "and") for g in groups if g]
    return TextQuery(text, _conj(ors, "or"))


def text_query(text: str | None, dictionary: str = "simple") -> TextQuery | None:
    """The per-call choice: NULL -> no query; ``^".*"$`` -> phrase of the text
    trimmed of ``\\`` and ``"`` at both ends; otherwise websearch syntax."""
    if text is None:
        return None
    if re.fullmatch(r'".*"', text, flags=re.S):
        return phrase_query(text.strip('\\"'), dictionary)
    return websearch_query(text, dictionary)


# --------------------------------------------------------------------------
# Match (L8) and rank
# --------------------------------------------------------------------------
def _positions(ents: Column) -> Column:
    return F.transform(ents, lambda e: e.pos)


def _match(node: Node, ents: dict[str, Column]) -> Column:
    if node.op == "lex":
        return F.size(ents[node.lexeme]) > 0
    if node.op == "and":
        c = _match(node.kids[0], ents)
        for k in node.kids[1:]:
            c = c & _match(k, ents)
        return c
    if node.op == "or":
        c = _match(node.kids[0], ents)
        for k in node.kids[1:]:
            c = c | _match(k, ents)
        return c
    if node.op == "not":
        return ~_match(node.kids[0], ents)
    if node.op == "phrase":
        # positions p of the first lexeme with lexeme k at p + k, by shifting
        # and intersecting: linear, no nested lambda
        cur = _positions(ents[node.kids[0].lexeme])
        for k in node.kids[1:]:
            cur = F.array_intersect(F.transform(cur, lambda p: p + 1), _positions(ents[k.lexeme]))
        return F.size(cur) > 0
    raise ValueError(node.op)


def _word_distance(g: Column) -> Column:
    return F.when(g > 100, F.lit(1e-30)).otherwise(
        F.lit(1.0) / (F.lit(1.005) + F.lit(0.05) * F.exp(g.cast("double") / 1.5 - 2)))


def _rank_and(lexs: list[str], ents: dict[str, Column]) -> Column:
    return rank_and_data(F.array(*[ents[x] for x in lexs]))


def _rank_or(lexs: list[str], ents: dict[str, Column]) -> Column:
    return rank_or_data(F.array(*[ents[x] for x in lexs]))


def _compiled(q: TextQuery, tsv: Column) -> Column:
    """``struct(match, rank)``; every lexeme's positions computed once per row."""
    lexs = q.distinct_lexemes()
    names = {x: f"e{k}" for k, x in enumerate(lexs)}

    def body(s):
        ents = {x: s[names[x]] for x in lexs}
        match = _match(q.tree, ents)
        if q.tree.op in ("and", "phrase") and len(lexs) >= 2:
            rank = _rank_and(lexs, ents)
        else:
            rank = _rank_or(lexs, ents)
        rank = F.when(rank < 0, F.lit(1e-20)).otherwise(rank)
        return F.struct(match.alias("match"), rank.alias("rank"))

    def bind(t):
        return let({names[x]: lexeme_entries(t.tsv, x) for x in lexs}, body)
    return let({"tsv": tsv}, bind)


def compile_query(q: TextQuery, tsv: Column) -> tuple[Column, Column]:
    """(``tsv @@ q``, ``ts_rank(tsv, q)``) with default weights and no
    normalisation. A query without lexemes matches nothing. Both columns come
    from one struct; bind it once (``match_rank``) when using both."""
    mr = match_rank(q, tsv)
    return mr.match, mr.rank


def match_rank(q: TextQuery, tsv: Column) -> Column:
    if q.tree is None:
        return F.struct(F.lit(False).alias("match"), F.lit(0.0).alias("rank"))
    return _compiled(q, tsv)


# --------------------------------------------------------------------------
# Substring test
# --------------------------------------------------------------------------
def like_pattern(q: str) -> str:
    """``%q%`` as a LIKE pattern with ``\\`` escapes: ``%`` and ``_`` in the
    query stay wildcards; a backslash before an ordinary character is
    dropped, since only ``\\%``, ``\\_`` and ``\\\\`` are escapes here."""
    out, i = [], 0
    while i < len(q):
        ch = q[i]
        if ch == "\\":
            if i + 1 >= len(q):
                raise ValueError("LIKE pattern must not end with escape character")
            nxt = q[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
            continue
        out.append(ch)
        i += 1
    return "%" + "".join(out) + "%"


def ilike_contains(content: Column, q: str) -> Column:
    return content.ilike(like_pattern(q))


def lexical_score(q_text: str | None, tsv: Column, content: Column,
                  dictionary: str = "simple") -> Column:
    """Q4: ts_rank if the text query matches, else 1 on a substring hit, else 0."""
    tq = text_query(q_text, dictionary)
    if tq is None:
        return F.lit(0.0)
    return let({"mr": match_rank(tq, tsv)}, lambda s: F.coalesce(
        F.when(s.mr.match, s.mr.rank)
         .when(ilike_contains(content, q_text), F.lit(1.0))
         .otherwise(F.lit(0.0)), F.lit(0.0)))


def word_distance_py(g: int) -> float:
    """Reference value of the distance weight, for tests."""
    return 1e-30 if g > 100 else 1.0 / (1.005 + 0.05 * math.exp(g / 1.5 - 2))


# --------------------------------------------------------------------------
# Queries as data (Q9): one plan for any number of different text queries
# --------------------------------------------------------------------------
PARSED_QUERY_TYPE = ("struct<lexemes: array<string>, groups: array<array<struct<neg: boolean, "
                     "phrase: boolean, lexemes: array<string>>>>, use_and: boolean, pattern: string>")


def _operands(node: Node) -> list[dict]:
    if node.op == "and":
        out: list[dict] = []
        for k in node.kids:
            out.extend(_operands(k))
        return out
    neg = node.op == "not"
    inner = node.kids[0] if neg else node
    if inner.op == "lex":
        return [{"neg": neg, "phrase": True, "lexemes": [inner.lexeme]}]
    if inner.op == "phrase":
        return [{"neg": neg, "phrase": True, "lexemes": [k.lexeme for k in inner.kids]}]
    if inner.op == "and":
        return [{"neg": neg, "phrase": False, "lexemes": inner.lexemes()}]
    raise ValueError(inner.op)


def parsed_query(text: str | None, dictionary: str = "simple") -> dict | None:
    """A text query as a value of ``PARSED_QUERY_TYPE``: its distinct lexemes,
    its or-groups of (negated) phrase / and operands, the rank it uses, and
    its substring pattern. ``None`` for a NULL query."""
    tq = text_query(text, dictionary)
    if tq is None:
        return None
    lexs = tq.distinct_lexemes()
    groups: list[list[dict]] = []
    if tq.tree is not None:
        ors = tq.tree.kids if tq.tree.op == "or" else [tq.tree]
        groups = [_operands(g) for g in ors]
    use_and = tq.tree is not None and tq.tree.op in ("and", "phrase") and len(lexs) >= 2
    return {"lexemes": lexs, "groups": groups, "use_and": use_and, "pattern": like_pattern(text)}


def rank_and_data(ents: Column) -> Column:
    """``_rank_and`` over ``ARRAY<ARRAY<STRUCT<pos, w>>>`` (one per lexeme).

    The entries are flattened in lexeme order, each carrying the index where
    the next lexeme's entries start; one fold then visits every pair of
    entries of different lexemes exactly once, with scalar accumulators."""
    sizes = F.transform(ents, lambda e: F.size(e))
    starts = F.transform(sizes, lambda _s, i: F.aggregate(
        F.slice(sizes, 1, i + 1), F.lit(0), lambda a, x: a + x) + 1)

    def flat_of(b):
        return F.flatten(F.transform(ents, lambda e, li: F.transform(e, lambda t: F.struct(
            t.pos.alias("pos"), t.w.alias("w"), F.element_at(b.starts, li + 1).alias("nxt")))))

    def body(b):
        flat = b.flat
        n = F.size(flat)

        def later(p):
            return F.slice(flat, p.nxt, F.greatest(n - p.nxt + 1, F.lit(0)))

        def factor(p, q):
            return F.when(p.pos == q.pos, F.lit(1.0)).otherwise(
                F.lit(1.0) - F.sqrt(p.w * q.w * _word_distance(F.abs(p.pos - q.pos))))
        prod = F.aggregate(flat, F.lit(1.0), lambda acc, p: acc * F.aggregate(
            later(p), F.lit(1.0), lambda a, q: a * factor(p, q)))
        any_pair = F.exists(flat, lambda p: F.exists(later(p), lambda q: q.pos != p.pos))
        return F.when(any_pair, F.lit(1.0) - prod).otherwise(F.lit(1e-20))
    return let({"starts": starts}, lambda b0: let({"flat": flat_of(b0)}, body))


def rank_or_data(ents: Column) -> Column:
    """``_rank_or`` over ``ARRAY<ARRAY<STRUCT<pos, w>>>``."""
    def one(e):
        ws = F.transform(e, lambda t: t.w)
        wmax = F.array_max(ws)
        jm = F.array_position(ws, wmax)
        s = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(e), F.lit(1))), F.lit(0.0),
                        lambda acc, j: acc + F.coalesce(F.try_element_at(ws, j), F.lit(0.0)) / (j * j))
        return F.when(F.size(e) > 0, (wmax + s - wmax / (jm * jm)) / ZETA2).otherwise(F.lit(0.0))
    total = F.aggregate(ents, F.lit(0.0), lambda acc, e: acc + one(e))
    return total / F.greatest(F.size(ents), F.lit(1)).cast("double")


def match_data(pq: Column, ents: Column) -> Column:
    """``tsv @@ q`` for a parsed query ``pq`` and its lexemes' positions
    ``ents`` (aligned with ``pq.lexemes``)."""
    def of(x):
        return F.element_at(ents, F.array_position(pq.lexemes, x).cast("int"))

    def operand(o):
        first = _positions(of(F.element_at(o.lexemes, 1)))
        rest = F.slice(o.lexemes, 2, F.greatest(F.size(o.lexemes) - 1, F.lit(0)))
        chain = F.aggregate(rest, first, lambda cur, x: F.array_intersect(
            F.transform(cur, lambda p: p + 1), _positions(of(x))))
        m = F.when(o.phrase, F.size(chain) > 0).otherwise(
            F.forall(o.lexemes, lambda x: F.size(of(x)) > 0))
        return F.when(o.neg, ~m).otherwise(m)
    return F.exists(pq.groups, lambda g: F.forall(g, operand))


def lexical_score_data(pq: Column, ents: Column, content: Column) -> Column:
    """Q4 for a per-row parsed query: 0 for a NULL query."""
    rank = F.when(pq.use_and, rank_and_data(ents)).otherwise(rank_or_data(ents))
    rank = F.when(rank < 0, F.lit(1e-20)).otherwise(rank)
    hit = F.ilike(content, pq.pattern, F.lit("\\"))
    return F.when(pq.isNull(), F.lit(0.0)).otherwise(F.coalesce(
        F.when(match_data(pq, ents), rank).when(hit, F.lit(1.0)).otherwise(F.lit(0.0)), F.lit(0.0)))
