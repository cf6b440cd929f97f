"""Proportional stratified interleaving of documents into shards.

Rows of each source are put in a seeded random order; the row of rank r (from 0)
among the n rows of its source has the fractional rank (r + o) / n, where the
offset o between 0 and 1 is the source's own. In the order of fractional ranks
every source is spread evenly, and sources of one or a few rows do not meet in
the middle, so any run of rows holds the mixture of the whole. The order is cut
into shards of equal counts (at most one row apart).

Ranks come from windows over small groups: a source's rows, and then all rows,
are dealt into buckets by the leading part of the sort key, a bucket's rank
starts after the rows of the buckets before it, and each bucket holds about
``bucket_rows`` rows whatever share of the rows its source has. Rows that are
equal in all that is read are first counted, then dealt out again with a number
each, so a row that is there very often lies in as many buckets as others do.
Texts are read once, for their size and checksum.

The law kept is ``rows``; equal texts may lie in different shards, as a group
of copies larger than a shard could not keep it. Defined cases: a null text has
no bytes and the checksum of none; a null source is a source of its own;
repeated rows are rows of their own, in any order among themselves; fewer rows
than shards leave some shards empty; an empty table gives no rows; other
columns are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded, materialise

SHARDS = 40
SEED = 20_240_501
BUCKET_ROWS = 1_000
GROUP_BUCKETS = 10_000
COPIES = 1_000
ROW_BYTES = 16


def _ranked(df: DataFrame, group: list[str], key: str, order: list[str], buckets: int,
            out: str) -> DataFrame:
    """``df`` (from files) with ``out``: the rank from 0 by ``key`` (0 to 1), then
    ``order``, among the rows of equal ``group``."""
    bucket = F.least(F.floor(F.col(key) * buckets), F.lit(buckets - 1)).alias("_bucket")
    dealt = df.select("*", bucket)
    sizes = materialise(dealt.groupBy(*group, "_bucket").agg(F.count("*").alias("_n")), "buckets")
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    # rows before a bucket: those of the buckets before it in its group of buckets,
    # and those of the groups before
    many = F.floor(F.col("_bucket") / GROUP_BUCKETS)
    ahead = Window.partitionBy(*group, "_many").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*group).orderBy("_many").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_many", many)
    groups = sizes.groupBy(*group, "_many").agg(F.sum("_n").alias("_of"))
    groups = groups.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_many").alias("_m"),
                           F.coalesce(F.sum("_of").over(above), F.lit(0)).alias("_above"))
    on = F.col("_many") == F.col("_m")
    for e in same:
        on = on & e
    sizes = (sizes.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
             .join(bounded(materialise(groups, "bucket-groups")), on)
             .select(*[F.col(f"_g{i}") for i in range(len(group))], F.col("_bucket").alias("_b"),
                     (F.col("_ahead") + F.col("_above")).alias("_before")))
    within = Window.partitionBy(*group, "_bucket").orderBy(key, *order)
    counted = dealt.withColumn("_at", F.row_number().over(within) - 1)
    on = F.col("_bucket") == F.col("_b")
    for s in same:
        on = on & s
    return (counted.join(bounded(materialise(sizes, "bucket-sizes")), on)
            .select(*df.columns, (F.col("_at") + F.col("_before")).cast("long").alias(out)))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, text_crc32, place (global, from 0), shard, slot."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    read = ["doc_id", "source", "size", "text_crc32"]
    slim = docs.select("doc_id", "source", (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(data).cast("long").alias("text_crc32"))

    def unit(*of):
        return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / float(1 << 53)

    # equal rows get numbers, in two steps so that no task writes all of them
    counted = materialise(slim.groupBy(*read).agg(F.count("*").alias("c")), "distinct-rows")
    runs = counted.select(*read, "c", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("c") - 1, F.lit(COPIES).cast("long"))).alias("at"))
    if not counted.where(F.col("c") > COPIES).isEmpty():
        runs = runs.repartition("doc_id", "at")
    copy = F.explode(F.sequence("at", F.least(F.col("at") + COPIES, F.col("c")) - 1)).alias("copy")
    slim = materialise(runs.select(*read, copy).select(
        *read, unit(F.lit(seed), *read, "copy").alias("u"),
        F.xxhash64(F.lit(seed + 1), "doc_id", "text_crc32", "copy").alias("tie")), "shard-rows")
    n = slim.count()
    buckets = max(1, n // bucket_rows)
    ranked = _ranked(slim, ["source"], "u", ["tie", "doc_id"], buckets, "rank")
    sizes = slim.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("_n"))
    sizes = bounded(materialise(sizes, "source-sizes"))
    ranked = (ranked.join(sizes, F.col("source").eqNullSafe(F.col("_s")))
              .withColumn("share", (F.col("rank") + unit(F.lit(seed + 2), "source")) / F.col("_n"))
              .drop("_s", "_n", "u", "rank"))
    placed = _ranked(materialise(ranked, "shard-ranks"), [], "share", ["tie", "doc_id"], buckets,
                     "place")
    # whole-number division: shard s begins at the least place with place * shards >= s * n
    which = F.expr(f"int(place * {shards} div {max(n, 1)})")
    start = F.expr(f"(int(place * {shards} div {max(n, 1)}) * {n}L + {shards - 1}) div {shards}")
    return placed.select("doc_id", "source", "size", "text_crc32", "place",
                         which.alias("shard"), (F.col("place") - start).alias("slot"))
