"""Filter interaction audit by path counting on the subset lattice.

Every document gets a mask: bit i is set if it fails filter i. Documents are
counted by part, mask and label, and nothing else of them is needed.

A state of the lattice is the set of filters applied so far, an edge applies one
more. An edge removes the documents that fail its filter and none of the state's.
The number of orders that reach a state (forward) and that lead from it to the
full set (backward) follow by dynamic programming over the states' sizes; an
edge lies on forward(its start) x backward(its end) orders. Weighting an edge's
removals by that number gives the Shapley sums; the steps of one order are the
edges along its path.

The lattice depends on the filters alone (2^n states, n of at most ``MAX_FILTERS``);
the documents are counted in Spark. Equal texts never meet in one task: the
least doc_id of each text is found with map-side combining, and a document is
matched to it by (text, doc_id).

Defined cases: a null text counts as empty; a null language is the part "";
rows equal in doc_id and text do not repeat each other (only a smaller doc_id
makes a copy); a row without doc_id is no copy and makes none; a document with
several label rows counts as good or toxic if any row says so; an empty table
has no parts and gives no rows; other columns are not read."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_or_empty

MAX_FILTERS = 6
_BLANK = r"[\x20\x09-\x0D]+"


def text_filters() -> dict[str, Column]:
    """Failure conditions on the column ``text``: A short, B repetitive, C upper
    case, D symbols."""
    text = F.col("text")
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": F.size(words) < 100,
            "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
            "C": 100 * capitals > 10 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


COPY = "E"


def masks(docs: DataFrame, filters: dict[str, Column], copy: str | None = COPY) -> DataFrame:
    """(doc_id, part, mask, n): how many rows of ``docs`` have that id, part and
    mask of failed filters. ``filters`` are conditions on ``text``, bit 0 first;
    ``copy`` names one more, last, that fails where a smaller doc_id has the
    same text."""
    bits = [F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(filters.values())]
    rows = (docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        text_or_empty().alias("text"))
            .select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("same"),
                    sum(bits[1:], bits[0]).alias("mask") if bits else F.lit(0).alias("mask"))
            .groupBy("same", "doc_id", "part", "mask").agg(F.count("*").alias("n")))
    if copy is None:
        return rows.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    first = (docs.select("doc_id", F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("same"))
             .groupBy("same").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
             .withColumn("_first", F.lit(True)))
    later = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return (rows.join(first, ["same", "doc_id"], "left")
            .groupBy("doc_id", "part",
                     (F.col("mask") + F.when(later, 1 << len(filters)).otherwise(0)).alias("mask"))
            .agg(F.sum("n").alias("n")))


def count_masks(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and those
    labelled quality 1 and toxic 1."""
    told = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                 F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))

    def counted(flag: str) -> Column:
        return F.sum(F.when(F.col(flag) == 1, F.col("n")).otherwise(0)).alias(flag)

    return (marked.join(told, "doc_id", "left").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), counted("good"), counted("toxic")))


def lattice(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders) of every edge: how many orders of ``n`` filters
    apply that filter right after exactly that set of others."""
    full = (1 << n) - 1
    by_size = sorted(range(full + 1), key=lambda s: (bin(s).count("1"), s))
    forward, backward = {0: 1}, {full: 1}
    for s in by_size[1:]:
        forward[s] = sum(forward[s ^ 1 << i] for i in range(n) if s >> i & 1)
    for s in reversed(by_size[:-1]):
        backward[s] = sum(backward[s | 1 << i] for i in range(n) if not s >> i & 1)
    return [(s, i, forward[s] * backward[s | 1 << i])
            for s in by_size for i in range(n) if not s >> i & 1]


def audit(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters ``names`` and step of it."""
    n = len(names)
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"the {factorial(n):,} orders of {n} filters are not listed; at most {MAX_FILTERS}")
    spark = counts.sparkSession
    edges = lattice(n)
    # which edges a document of each mask is removed by, and whether it passes the edge's end
    hits = spark.createDataFrame(
        [(m, s, i, int(m >> i & 1 and not m & s), int(not m & (s | 1 << i)), int(m >> i & 1),
          int(m == 1 << i)) for m in range(1 << n) for s, i, _ in edges],
        "mask int, state int, filter int, removes int, keeps int, fails int, alone int")

    def total(of: str, flag: str, name: str) -> Column:
        return F.sum(F.col(of) * F.col(flag)).alias(name)

    by_edge = (counts.join(F.broadcast(hits), "mask").groupBy("part", "state", "filter")
               .agg(total("n", "keeps", "kept"), total("n", "removes", "removed"),
                    total("n", "fails", "fails"), total("n", "alone", "unique_fails"),
                    total("good", "removes", "good_lost"), total("toxic", "removes", "toxic_lost")))
    weights = spark.createDataFrame(edges, "state int, filter int, orders long")
    worth = (by_edge.join(F.broadcast(weights), ["state", "filter"]).groupBy("part", "filter")
             .agg(F.sum(F.col("orders") * F.col("removed")).alias("shapley")))
    steps = spark.createDataFrame(
        [("".join(names[i] for i in order), step + 1, sum(1 << i for i in order[:step]), order[step])
         for order in permutations(range(n)) for step in range(n)],
        "filter_order string, step int, state int, filter int")
    return (by_edge.join(worth, ["part", "filter"]).join(F.broadcast(steps), ["state", "filter"])
            .select("part", "filter_order", "step", "kept", "removed",
                    (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
                    "good_lost", "toxic_lost", "shapley"))
