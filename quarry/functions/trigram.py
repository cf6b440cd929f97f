"""Trigram similarity (L12), re-aimed from a trigram index: the similarity
of two strings and a fuzzy filter against a literal, all native.

Grams: lower-case, split into words of letters and digits, pad each word
with two blanks before and one after, take every 3-character window; the
set of distinct grams of all words. Similarity = shared / all grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import config
from quarry.functions.text import WORD_RE
from quarry.functions.util import let


def grams(s: Column) -> Column:
    ws = F.regexp_extract_all(F.lower(F.coalesce(s, F.lit(""))), F.lit(WORD_RE), 0)

    def of_word(w):
        p = F.concat(F.lit("  "), w, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: p.substr(i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(ws, of_word)))


def py_grams(s: str) -> list[str]:
    import re
    out: list[str] = []
    for w in re.findall(r"[^\W_]+", s.lower()):
        p = "  " + w + " "
        for i in range(len(p) - 2):
            g = p[i:i + 3]
            if g not in out:
                out.append(g)
    return out


def similarity(a: Column, b: Column) -> Column:
    """``|A & B| / |A | B|`` of the two gram sets; 0 when both are empty."""
    def body(s):
        u = F.size(F.array_union(s.a, s.b))
        return F.when(u == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(s.a, s.b)) / u)
    return let({"a": grams(a), "b": grams(b)}, body)


def similarity_to(a: Column, literal: str) -> Column:
    qg = py_grams(literal)
    q = F.array(*[F.lit(g) for g in qg]) if qg else F.array().cast("array<string>")

    def body(s):
        u = F.size(F.array_union(s.a, q))
        return F.when(u == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(s.a, q)) / u)
    return let({"a": grams(a)}, body)


def fuzzy_match(a: Column, literal: str, threshold: float = config.TRIGRAM_THRESHOLD) -> Column:
    """The ``%`` test: similarity at least the threshold."""
    return similarity_to(a, literal) >= F.lit(float(threshold))


def _ranked(values: DataFrame, name: str, freq: DataFrame) -> DataFrame:
    """(name, n, g): each distinct string with its grams, rarest in the lookup first."""
    held = values.select(F.col(name), F.explode(grams(F.col(name))).alias("gram"))
    rare = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")
    g = F.transform(F.sort_array(F.collect_list(rare)), lambda x: x["gram"])
    return (held.join(freq, "gram", "left").groupBy(name).agg(g.alias("g"))
            .select(name, F.size("g").alias("n"), "g"))


def _prefixes(ranked: DataFrame, name: str, n: str, pos: str, threshold: float) -> DataFrame:
    """(name, n, gram, pos): the grams of which a similar string must have one."""
    length = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    return ranked.select(name, F.col("n").alias(n), F.posexplode(
        F.slice("g", 1, length.cast("int"))).alias(pos, "gram"))


def join_candidates(left: DataFrame, a: str, right: DataFrame, b: str, threshold: float) -> DataFrame:
    """Pairs (a, b) of ranked strings that pass the prefix, length and position
    filters: both prefixes hold a gram, neither has less than ``threshold`` of the
    other's grams, and at that gram enough may still follow."""
    t = F.lit(float(threshold))
    p = (_prefixes(left, a, "na", "i", threshold).join(_prefixes(right, b, "nb", "j", threshold), "gram"))
    needed = F.ceil(t / (1 + t) * (F.col("na") + F.col("nb")) - 1e-9)
    left_over = F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"))  # this gram and later ones
    return (p.where((F.col("nb") >= t * F.col("na") - 1e-9) & (F.col("na") >= t * F.col("nb") - 1e-9)
                    & (left_over >= needed)).select(a, b).distinct())


def fuzzy_join(table: DataFrame, key: str, col: str, lookup: DataFrame, term: str,
               threshold: float = config.TRIGRAM_THRESHOLD) -> DataFrame:
    """Rows of ``table`` whose ``col`` is similar (>= threshold) to a term of
    ``lookup``: ``key, term, sim``. The join form of the trigram index, on distinct
    strings: grams are ordered by their frequency in the lookup, and only the rarest
    grams of each string, of which a similar one must share one, are joined
    (``join_candidates``); the pairs left are compared on all their grams. Every
    step is a shuffled join or aggregation of bounded rows; AQE splits hot grams."""
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    terms = lookup.select(F.col(term).alias("term")).where(F.col("term").isNotNull()).distinct()
    values = table.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    freq = terms.select(F.explode(grams(F.col("term"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    left, right = _ranked(values, "_v", freq), _ranked(terms, "term", freq)
    pairs = join_candidates(left, "_v", right, "term", threshold)
    both = (pairs.join(left.select("_v", F.col("g").alias("a"), F.col("n").alias("na")), "_v")
            .join(right.select("term", F.col("g").alias("b"), F.col("n").alias("nb")), "term"))
    s = F.size(F.array_intersect("a", "b"))
    sim = let({"s": s, "n": F.col("na") + F.col("nb")}, lambda x: x.s / (x.n - x.s))
    found = both.select("_v", "term", sim.alias("sim")).where(F.col("sim") >= F.lit(float(threshold)))
    return table.select(F.col(key), F.col(col).alias("_v")).join(found, "_v").select(key, "term", "sim")
