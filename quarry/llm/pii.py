"""Personal data: fixed patterns, and identifiers found by their context.

Base spans are the leftmost non-overlapping matches of one pattern per kind
(``KINDS``), less those that fail the kind's test. They are the seeds of a
bootstrap: the words around a seed make lexical patterns ("w2 w1 _" from the two
words before it, "w1 _ w" from the word before and after); words end at blanks,
double quotes, commas, semicolons, square and curly brackets and the signs
< > & ? = |. Everything else that looks like an identifier is an instance of
the patterns around it: tokens between blanks, runs of digit groups joined by
single blanks, dots, hyphens or round brackets (of at most 19 digits, the most
of any kind), and the parts of every token. Patterns
and instances form a graph on which Spark passes scores back and forth for
``ROUNDS`` rounds. A pattern's confidence in a kind is the sum of its distinct
instances' scores over the number of its seeds of every kind, plus one, plus
``DAMPING`` for each unseen instance that has a score. An instance's score is
``DAMPING`` times its best pattern's confidence, and seeds stay at 1 for their
own kind. So seeds of other kinds speak against a pattern; unseen instances
alone leave its confidence as it is, and raise it where surer patterns back
them. Patterns with ``SUPPORT`` distinct seeds or more and confidence of
``CONFIDENT`` or more mark the unseen identifiers that they surround.

Positions count code points; ends are exclusive. Only DataFrame functions are
used. Base patterns are written for a backtracking engine: possessive, and
tried only where a match can begin, so that long runs take linear time; what
they match is the same. Contexts look at most ``REACH`` characters far, which
defines a pattern's words; whole texts are searched. Places are running sums over
a text's matches, spans and tokens are compared in one merge, and contexts are cut
from pieces of ``PIECE`` characters, so the work grows with the number of matches.

Defined cases: a null text counts as empty and has no spans; rows equal in
doc_id and text get the same result; discovered spans never overlap base spans,
but may hold one another (a run of digit groups and one of its tokens);
an empty table gives no rows; other columns pass through unread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.util import let
from quarry.functions.util import scan as fold
from quarry.llm.common import bounded, free_name, materialise

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
DAMPING = 0.5
SUPPORT = 3
CONFIDENT = 0.7
REACH = 80
PIECE = 1_024

# A match of the first begins where no address character precedes it, or where
# the last match ended; of the second, not inside digits; the third holds 13 to
# 19 digits and all of a run of digits with single blanks or hyphens between.
_PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text without this cannot hold the kind
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# digit groups, at least two; not begun inside a run
_RUN = (r"(?<![\p{L}\p{N}])(?<![0-9][\x20.-])(?<![0-9]\))(?<![0-9]\)[\x20-])[+(]{0,2}[0-9]++"
        r"(?:(?:\)[\x20-]?|[\x20.-]?\(|[\x20.-])[0-9]++(?![\p{L}\p{N}]))++")
# what an identifier in unspaced text is made of
_PART = (r"(?<![\p{L}\p{N}@._%+-])[\p{L}\p{N}._%+\-&&[^0-9]]*+[0-9@]"
         r"[\p{L}\p{N}@._%+-]*+")
_WORD_END = r'[\s"{}\[\]<>&?=|,;]+'


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def term(d, i):
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    digits = F.split(F.reverse(_digits(value)), "")
    digits = F.filter(digits, lambda d: d != "")
    return F.aggregate(F.transform(digits, term), F.lit(0), lambda acc, x: acc + x) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(
            "^0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str, needs: str) -> Column:
    """(value, start) of all matches: a match begins where the one before ended,
    and the text between them."""
    def step(at, x):
        start = at["end"] + F.length(x["gap"])
        return (F.struct((start + F.length(x["value"])).alias("end")),
                F.struct(x["value"].alias("value"), start.alias("start")))

    def place(s):
        pairs = F.zip_with(s["m"], F.slice(s["gaps"], 1, F.size(s["m"])),
                           lambda x, gap: F.struct(x.alias("value"), gap.alias("gap")))
        return fold(pairs, F.struct(F.lit(0).cast("bigint").alias("end")), step,
                    "struct<value:string,start:bigint>")

    found = let({"m": F.regexp_extract_all(text, F.lit(pattern), 0),
                 "gaps": F.split(text, pattern, -1)}, place)
    return F.when(text.rlike(needs), found).otherwise(
        F.array().cast("array<struct<value:string,start:bigint>>"))


def _pieces(text: Column) -> Column:
    """``text`` in parts of ``PIECE`` characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0)


def _around(pieces: Column, start: Column, end: Column) -> Column:
    """The lexical patterns around a span of the text that ``_pieces`` cut."""
    def near(at, length):
        """``length`` characters from ``at`` on; they lie in two pieces at most."""
        i = F.floor(at / PIECE).cast("int")
        two = F.concat(F.coalesce(F.get(pieces, i), F.lit("")), F.coalesce(F.get(pieces, i + 1), F.lit("")))
        return F.substring(two, (at - i * PIECE + 1).cast("int"), length.cast("int"))

    def words(part):
        return F.filter(F.split(F.lower(part), _WORD_END), lambda w: w != "")

    before = words(near(F.greatest(start - REACH, F.lit(0)), F.least(start, F.lit(REACH))))
    after = words(near(end, F.lit(REACH)))

    def lexical(s):
        w1 = F.get(s["b"], F.size(s["b"]) - 1)
        w2 = F.get(s["b"], F.size(s["b"]) - 2)
        w = F.get(s["a"], F.lit(0))
        return F.filter(F.array(F.concat(w2, F.lit(" "), w1, F.lit(" _")),
                                F.concat(w1, F.lit(" _ "), w)), lambda p: p.isNotNull())

    return let({"b": before, "a": after}, lexical)


def _spans(text: Column) -> Column:
    """Base spans of all kinds: kind (its place in KINDS), start, end, value, around."""
    def of(k: int, kind: str) -> Column:
        ok = F.filter(_matches(text, _PATTERN[kind], _NEEDS[kind]),
                      lambda x: _passes(kind, x["value"]))
        return F.transform(ok, lambda x: F.struct(
            F.lit(k).alias("kind"), x["start"].alias("start"),
            (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value")))

    return F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)])


def _tokens(text: Column) -> Column:
    """What looks like an identifier, without the punctuation around it: six
    letters or digits or more, and four digits or an @."""
    def core(x):
        head = F.length(F.regexp_extract(x["value"], r"^([^\p{L}\p{N}+]*)", 1))
        value = F.regexp_replace(F.regexp_replace(x["value"], r"^[^\p{L}\p{N}+]++", ""),
                                 r"(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
        return F.struct((x["start"] + head).alias("start"), value.alias("value"))

    def parts(x):
        inside = F.transform(_matches(x["value"], _PART, "[0-9@]"), lambda y: F.struct(
            y["value"].alias("value"), (x["start"] + y["start"]).alias("start")))
        return F.concat(F.array(x), inside)

    found = F.flatten(F.transform(_matches(text, _TOKEN, "[0-9@]"), parts))
    # a token may be one of its own parts: equal ones are neighbours in order
    once = let({"c": F.sort_array(F.transform(found, core))}, lambda s: F.filter(
        s["c"], lambda x, i: (i == 0) | (F.get(s["c"], i - 1) != x)))
    tokens = F.filter(once, lambda x: x["value"].rlike(
        r"^(?s)(?=(?:[^\p{L}\p{N}]*+[\p{L}\p{N}]){6})(?:(?:[^0-9]*+[0-9]){4}|[^@]*+@)"))
    runs = F.filter(F.transform(_matches(text, _RUN, r"[0-9][\x20().-]"), core), lambda x: F.length(
        _digits(x["value"])).between(6, 19))
    return F.concat(tokens, runs)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, dk (hash of the text), spans (base) and tokens, both
    with the patterns around them. Written to files: texts are read once."""
    text = F.col("text")
    kind = "array<struct<kind:int,start:bigint,end:bigint,value:string>>"
    found = docs.select("doc_id", F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    found = found.select("doc_id", F.xxhash64("text").alias("dk"), F.when(
        text.rlike("[0-9@]"), let({"t": text}, lambda s: F.struct(
            _spans(s["t"]).cast(kind).alias("spans"), _tokens(s["t"]).alias("tokens"),
            s["t"].alias("text")))).alias("f"))

    def free(spans, tokens):
        """The tokens that no span overlaps: of the spans that begin no later, none
        reaches into the token, and the next one begins after it."""
        def mark(x, is_token, end):
            return F.struct(x["start"].alias("start"), F.lit(is_token).alias("is_token"), end.alias("end"),
                            x["value"].alias("value"))

        kind = "array<struct<start:bigint,is_token:int,end:bigint,value:string>>"
        inf = F.lit(1 << 60).cast("bigint")
        marks = F.sort_array(F.concat(
            F.transform(spans, lambda x: mark(x, 0, x["end"])).cast(kind),
            F.transform(tokens, lambda x: mark(x, 1, x["start"] + F.length(x["value"]))).cast(kind)))

        def reach(st, x):
            at = F.when(x["is_token"] == 0, F.greatest(st["at"], x["end"])).otherwise(st["at"])
            return F.struct(at.alias("at")), F.struct(
                x["start"].alias("start"), x["is_token"].alias("is_token"), x["end"].alias("end"),
                x["value"].alias("value"), ((x["is_token"] == 1) & (st["at"] <= x["start"])).alias("ok"))

        def following(st, x):
            at = F.when(x["is_token"] == 0, x["start"]).otherwise(st["at"])
            return F.struct(at.alias("at")), F.struct(
                x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                (x["ok"] & (st["at"] >= x["end"])).alias("ok"))

        ahead = fold(marks, F.struct(F.lit(-1).cast("bigint").alias("at")), reach,
                     "struct<start:bigint,is_token:int,end:bigint,value:string,ok:boolean>")
        back = let({"r": F.reverse(ahead)}, lambda z: fold(
            z["r"], F.struct(inf.alias("at")), following, "struct<start:bigint,end:bigint,value:string,ok:boolean>"))
        return F.filter(F.reverse(back), lambda x: x["ok"])

    def with_patterns(f):
        def marked(x, kind):
            return F.struct(kind.cast("int").alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                            x["value"].alias("value"), _around(f["pieces"], x["start"], x["end"]).alias("around"))

        spans = F.transform(f["spans"], lambda x: marked(x, x["kind"]))
        return F.concat(spans, F.transform(f["free"], lambda x: marked(x, F.lit(-1))))

    full = "array<struct<kind:int,start:bigint,end:bigint,value:string,around:array<string>>>"
    f = F.col("f")
    out = found.select("doc_id", "dk", F.when(f.isNotNull(), let(
        {"spans": f["spans"], "free": free(f["spans"], f["tokens"]), "pieces": _pieces(f["text"])},
        with_patterns).cast(full))
        .otherwise(F.array().cast(full)).alias("marks"))
    return materialise(out, "pii-marks")


def _confident(marks: DataFrame, rounds: int, support: int, confident: float) -> DataFrame:
    """(pattern, kind, conf) of the patterns that may mark unseen identifiers."""
    edges = materialise(marks.select(F.explode("m.around").alias("pattern"),
                                     F.lower("m.value").alias("value"), F.col("m.kind").alias("kind"))
                        .groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-edges")
    seeds = edges.where("kind >= 0").groupBy("value").agg(F.max("kind").alias("kind"))
    seeds = materialise(seeds.select("value", "kind", F.lit(1.0).alias("s"), F.lit(0.0).alias("w")),
                        "pii-seeds")
    kinds = (edges.select("pattern", "value").join(seeds, "value")
             .groupBy("pattern", "kind").agg(F.count("*").alias("held")))
    kinds = materialise(kinds, "pii-held")
    size = kinds.groupBy("pattern").agg(F.sum("held").alias("n"))  # seeds of every kind
    held = kinds.where(F.col("held") >= support)
    # only patterns with enough seeds ever speak; few among all patterns
    speaking = materialise(held.join(size, "pattern").select("pattern", "kind", "n"), "pii-speaking")
    edges = materialise(edges.select("pattern", "value").join(
        speaking.select("pattern").distinct(), "pattern", "left_semi"), "pii-graph")
    unseen = edges.join(seeds.select("value"), "value", "left_anti")
    score = seeds
    for _ in range(rounds):
        conf = (edges.join(score, "value").join(speaking, ["pattern", "kind"])
                .groupBy("pattern", "kind")
                .agg((F.sum("s") / (F.max("n") + 1 + F.sum("w"))).alias("conf")))
        conf = materialise(conf, "pii-confidence")
        reached = (unseen.join(conf, "pattern").groupBy("value", "kind")
                   .agg((F.max("conf") * DAMPING).alias("s"), F.lit(DAMPING).alias("w")))
        score = materialise(seeds.unionByName(reached), "pii-scores")
    return conf.where(F.col("conf") >= confident)


def discover(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT,
             confident: float = CONFIDENT) -> DataFrame:
    """(doc_id, dk, kind, start, end) of identifiers that confident patterns mark.
    ``found``: from ``scan``."""
    marks = found.select("doc_id", "dk", F.explode("marks").alias("m"))
    patterns = bounded(materialise(_confident(marks, rounds, support, confident), "pii-patterns"))
    hits = (marks.where("m.kind < 0")
            .select("doc_id", "dk", F.col("m.start").alias("start"), F.col("m.end").alias("end"),
                    F.explode("m.around").alias("pattern")).join(patterns, "pattern"))
    # the most confident pattern names the kind; ties go to the first kind
    best = F.max(F.struct("conf", (-F.col("kind")).alias("k")))
    return (hits.groupBy("doc_id", "dk", "start", "end").agg((-best["k"]).alias("kind"))
            .select("doc_id", "dk", "kind", "start", "end"))


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base and spans, arrays of (kind, start, end) in the
    order of kinds, then places; ``spans`` also has the discovered ones."""
    found = scan(docs)
    kind = "array<struct<kind:int,start:bigint,end:bigint>>"
    plain = F.sort_array(F.transform(F.filter("marks", lambda m: m["kind"] >= 0), lambda m: F.struct(
        m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"))).cast(kind))
    more = materialise(discover(found).groupBy(F.col("doc_id").alias("_id"), F.col("dk").alias("_dk"))
                       .agg(F.collect_list(F.struct("kind", "start", "end")).cast(kind)
                            .alias("more")), "pii-discovered")
    base = found.select("doc_id", "dk", plain.alias("base"))
    joined = base.join(bounded(more), F.col("doc_id").eqNullSafe(F.col("_id"))
                       & (F.col("dk") == F.col("_dk")), "left")
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(
        F.sort_array(F.concat("base", "more")))  # discovered spans overlap no base span
    return joined.select("doc_id", "dk", "base", every.alias("spans"))


def count(spans: Column, kind: str) -> Column:
    place = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == place)).cast("long")


def names(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "<{}>") -> DataFrame:
    """``docs`` with every span replaced by its kind; overlapping spans become
    one, named by the first. Columns stay as they are."""
    dk, spans = free_name(docs, "_dk"), free_name(docs, "_spans")
    found = (find(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "dk"])
             .select(F.col("doc_id").alias(dk + "i"), F.col("dk").alias(dk + "k"),
                     F.col("spans").alias(spans)))
    found = bounded(materialise(found, "pii-spans"))
    keyed = docs.withColumn(dk, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(found[dk + "i"])
                        & (keyed[dk] == found[dk + "k"]), "left")
    by_start = F.sort_array(F.transform(F.col(spans), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    tags = F.array(*[F.lit(mask.format(k)) for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    text = F.col("text")

    def step(acc, s):
        apart = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.when(apart, F.concat(acc["out"], gap, F.get(tags, s["kind"])))
                        .otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    def finish(acc):
        return F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.length(text)))

    new = F.when(F.col(spans).isNull(), text).otherwise(F.aggregate(by_start, start, step, finish))
    return joined.withColumn("text", new).select(*docs.columns)
