"""Line dedup by a deletion-neighbourhood join.

A document's lines are the parts of its text between line feeds; a line's words
are its parts between single blanks. The edit distance is counted in words
(one word put in, taken out or replaced), and the bound is one. An occurrence of
a line goes if an equal line occurs earlier, or if an earlier line is within the
bound and the longer of the two has ``min_words`` words or more; earlier means
smaller (doc_id, hash of the text, line number), and it does not matter whether
the earlier line goes itself. Blank lines always stay.

Every distinct line would emit itself and each variant with one word deleted,
as hashed keys. Two lines within the bound share their first or their last few
words, so lines that share neither with any other line are set aside first;
that loses nothing. The others are numbered in their order, and a variant is a
key, the place of its deletion and its line's number. Keys that occur once are
dropped by a count of the bare keys; equal keys of the rest are joined, not pair
by pair but each with the earliest line of its key (and of the place of its
deletion), which is enough to know whether an earlier neighbour exists. Each
such pair is verified on the words. Keys have 64 bits, the length mixed in.

Only DataFrame functions are used. A side is broadcast only after its size was
measured (see ``bounded``); larger ones are shuffled. Variants are shuffled at
every size.

Defined cases: a null text has no lines and stays null; an empty text is one
blank line; rows equal in doc_id and text are one document written twice and
get the same result; a null doc_id sorts first; other columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.util import let
from quarry.llm.common import bounded, free_name, materialise

MIN_WORDS = 5
_P = (1 << 61) - 1


def _split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _words(line: Column) -> Column:
    return F.split(line, " ", -1)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, dk (hash of the text), no, line of all lines that aren't blank."""
    return (docs.where("text IS NOT NULL")
            .select("doc_id", F.xxhash64("text").alias("dk"),
                    F.posexplode(_split_lines(F.col("text"))).alias("no", "line"))
            .where(F.rtrim(F.col("line"), F.lit(" \t\r")) != ""))


def _identity(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def _end_keys(line: Column, min_words: int) -> Column:
    """Keys of the first and last words: how many, depends on the power of two
    below the word count, so that lines whose counts differ by one share it. A
    count that is a power of two also uses the power below."""
    n = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    power = F.floor(F.log2(n.cast("double") + 0.5)).cast("int")

    def ends(p: Column) -> list[Column]:
        h = F.call_function("shiftleft", F.lit(1), p - 1)
        return [F.xxhash64(F.lit(side), p, F.call_function("substring_index", line, F.lit(" "),
                                                           h if side else -h)) for side in (0, 1)]

    at_power = F.call_function("shiftleft", F.lit(1), power) == n
    return (F.when(n < min_words - 1, F.array().cast("array<bigint>"))
            .when(at_power & (n >= min_words), F.array(*ends(power), *ends(power - 1)))
            .otherwise(F.array(*ends(power))))


def _variants(words: Column, min_words: int = MIN_WORDS) -> Column:
    """(pos, key) of a line's words: pos -1 is the line itself, pos i the line
    without word i; lines of fewer than ``min_words`` give themselves only. A sequence's key is the sum of the hashes of (word, place);
    deleting word i moves the later ones by one place, so each key is a prefix
    sum away from the sum of all moved hashes. Prefix sums are taken in pieces
    of about the square root of the length."""
    def add(acc, x):
        return (acc + x) % _P

    def total(xs):
        return F.aggregate(xs, F.lit(0).cast("bigint"), add)

    def hashes(shift):
        return F.transform(words, lambda w, i: F.pmod(F.xxhash64(w, i - shift), F.lit(_P)))

    def prefix(s):
        size = F.size(s["moved"])
        step = F.ceil(F.sqrt(size.cast("double"))).cast("int")
        diff = F.zip_with(s["here"], s["moved"], lambda a, b: (a + (_P - b)) % _P)
        return let({"d": diff, "moved": s["moved"], "all": total(s["here"]),
                    "all_moved": total(s["moved"]), "step": step}, starts)

    def starts(s):
        pieces = F.transform(F.sequence(F.lit(0), (F.size(s["d"]) - 1).cast("int"), s["step"]),
                             lambda at: total(F.slice(s["d"], at + 1, s["step"])))
        return let({"p": pieces, "s": s}, sums)

    def sums(t):
        s = t["s"]
        before = F.transform(t["p"], lambda _, k: total(F.slice(t["p"], 1, k)))
        return let({"b": before, "s": s}, keys)

    def keys(t):
        s = t["s"]
        one = F.transform(s["moved"], lambda m, i: F.struct(
            i.alias("pos"),
            ((F.get(t["b"], F.floor(i / s["step"]).cast("int"))
              + total(F.slice(s["d"], F.floor(i / s["step"]).cast("int") * s["step"] + 1,
                              i % s["step"])) + s["all_moved"] + (_P - m)) % _P).alias("key")))
        itself = F.array(F.struct(F.lit(-1).alias("pos"), s["all"].alias("key")))
        return F.when(F.size(s["d"]) >= min_words, F.concat(itself, one)).otherwise(itself)

    return let({"here": hashes(0), "moved": hashes(1)}, prefix)


def _within_one(a: Column, b: Column, min_words: int) -> Column:
    """Word sequences at most one edit apart: common start and common end cover
    all but one word of the longer."""
    def common(x, y):
        same = F.zip_with(x, y, lambda p, q: p.eqNullSafe(q))
        at = F.array_position(same, False)
        return F.when(at == 0, F.least(F.size(x), F.size(y))).otherwise(at - 1)

    longer = F.greatest(F.size(a), F.size(b))
    return ((F.abs(F.size(a) - F.size(b)) <= 1) & (longer >= min_words)
            & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1))


_PLACE = ("doc_id", "dk", "no")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, dk, no, near) of every line occurrence that goes."""
    place = F.struct(*_PLACE)
    lines = _lines(docs).select(*_PLACE, *_identity(F.col("line")),
                                _end_keys(F.col("line"), min_words).alias("ends"))
    firsts = materialise(lines.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.count("*").alias("n"), F.first("ends").alias("ends")),
        "first-lines")
    again = bounded(materialise(firsts.where("n > 1").select("h1", "h2", "first"), "repeated"))
    exact = (lines.select(*_PLACE, "h1", "h2").join(again, ["h1", "h2"])
             .where(place != F.col("first"))
             .select(*_PLACE, F.lit(False).alias("near")))
    near = _near_lines(docs, firsts, min_words).withColumn("near", F.lit(True))
    return exact.unionByName(near)


def _candidates(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(line, doc_id, dk, no, text): the distinct lines that share an end with
    another, numbered in the order of their first places."""
    ends = firsts.select("h1", F.explode("ends").alias("end"))
    shared = (ends.groupBy("end").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
              .where("a <> b").select("end"))
    some = ends.join(bounded(materialise(shared, "shared-ends")), "end").select("h1").distinct()
    some = firsts.select("h1", "first.*").join(bounded(materialise(some, "candidate-hashes")),
                                               "h1", "left_semi").select(*_PLACE)
    lines = _lines(docs).withColumnRenamed("line", "text").alias("l")
    wanted = bounded(materialise(some, "candidates")).alias("w")
    same = F.col("l.doc_id").eqNullSafe(F.col("w.doc_id"))
    for c in _PLACE[1:]:
        same &= F.col(f"l.{c}") == F.col(f"w.{c}")
    found = (lines.join(wanted, same, "left_semi").dropDuplicates([*_PLACE])
             .repartitionByRange(*_PLACE).sortWithinPartitions(*_PLACE))
    return materialise(found.select(F.monotonically_increasing_id().alias("line"), *_PLACE, "text"),
                       "candidate-lines")


def _near_lines(docs: DataFrame, firsts: DataFrame, min_words: int) -> DataFrame:
    """First places of the lines that have an earlier line within one edit."""
    cand = _candidates(docs, firsts)
    v, words = F.col("v"), F.col("words")
    length = F.size(words) - F.when(v["pos"] < 0, 0).otherwise(1)
    variants = materialise(
        cand.select("line", _words(F.col("text")).alias("words"))
        .select("line", "words", F.explode(_variants(words, min_words)).alias("v"))
        .select(F.xxhash64(v["key"], length).alias("key"), v["pos"].alias("pos"), "line"), "variants")
    repeated = variants.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    met = materialise(variants.join(repeated.hint("merge"), "key", "left_semi"), "met-variants")
    least = met.groupBy("key", "pos").agg(F.min("line").alias("least"))
    least = materialise(least, "variant-places")
    of_key = least.groupBy("key").agg(F.min(F.when(F.col("pos") < 0, F.col("least"))).alias("whole"),
                                      F.min("least").alias("any"))
    groups = bounded(materialise(least.join(of_key, "key"), "variant-keys"))
    partners = F.when(F.col("pos") < 0, F.array("any")).otherwise(F.array("least", "whole"))
    pairs = (met.join(groups, ["key", "pos"]).select("line", F.explode(partners).alias("other"))
             .where(F.col("other") < F.col("line")).distinct())
    left = cand.select("line", *_PLACE, F.col("text").alias("a"))
    right = cand.select(F.col("line").alias("other"), F.col("text").alias("b"))
    found = pairs.join(left, "line").join(right, "other")
    return (found.where(_within_one(_words(F.col("a")), _words(F.col("b")), min_words))
            .select(*_PLACE).distinct())


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with ``gone`` (numbers of the lines that go, in order, or null)
    and ``near`` (how many of them are near, not equal), and those names."""
    gone, near, dk = (free_name(docs, x) for x in ("_gone", "_near", "_dk"))
    per_doc = materialise(repeated_lines(docs, min_words).groupBy(F.col("doc_id").alias("_id"), "dk").agg(
        F.sort_array(F.collect_set("no")).alias(gone),
        F.count_distinct(F.when(F.col("near"), F.col("no"))).alias(near)), "gone-lines")
    keyed = docs.withColumn(dk, F.xxhash64("text"))
    per_doc = per_doc.withColumnRenamed("_id", dk + "i").withColumnRenamed("dk", dk + "k")
    joined = keyed.join(bounded(per_doc), keyed["doc_id"].eqNullSafe(per_doc[dk + "i"])
                        & (keyed[dk] == per_doc[dk + "k"]), "left")
    return joined.drop(dk, dk + "i", dk + "k"), {"gone": gone, "near": near}


def kept_text(gone: Column, text: Column) -> Column:
    """``text`` without the lines numbered in ``gone``."""
    def rest(s):
        stay = F.array_except(F.sequence(F.lit(0), F.size(s["lines"]) - 1), s["gone"])
        return F.array_join(F.transform(stay, lambda i: F.get(s["lines"], i)), "\n")

    return F.when(gone.isNull(), text).otherwise(let({"lines": _split_lines(text), "gone": gone}, rest))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated lines, near ones of ``min_words`` words or more. A document all of whose lines (blank
    ones aside) go is a copy and goes too; ``n_chars`` follows the text where
    there is such a column."""
    found, name = line_report(docs, min_words)
    out = found.withColumn("text", kept_text(F.col(name["gone"]), F.col("text")))
    out = out.where(F.col(name["gone"]).isNull() | (F.trim(F.col("text"), F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(name["gone"]).isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
