"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: A-Z is lower-cased, words are runs of characters other than
U+0020 and U+0009 to U+000D, shingles are ``words`` consecutive words joined by
blanks, repeats included (a shorter text is one shingle; a text without words
has fingerprint 0). A bit is set if it is set in over half of the shingles'
XXH64 values (seed 42). Two fingerprints link at ``bits`` or fewer differing
bits; components of linked documents are the groups.

Links are found between distinct fingerprints. These are sorted by Gray rank
(neighbours in that order differ in few bits) and cut into blocks. The bits in
which all members of a block agree are the block's pattern; sixteen patterns in
a row share fewer bits, which their parent holds, and so on to one root. A
search goes down from the root, adds up the differences to the shared bits of
each node that its ancestors don't hold already, and leaves a whole group as
soon as the sum is over the limit. The index over blocks tells which later
blocks a fingerprint has to visit; each block's own index then finds its links.
This is done in two orders of the bits, either half first (see ``links``).
A block gives out a spanning forest of its links rather than the links, which
loses no connection, and grows with its members only.

At most ``TOP_NODES`` patterns (16 bytes each) reach the driver and are broadcast.
Where there are more blocks, those are of runs of blocks, and a fingerprint that
visits a run is sent to the patterns of its blocks. What visits a block or a run
is split into parts of about ``VISITORS`` fingerprints, each with all members or
patterns, so no task takes more however many come. Defined cases: null text counts as empty; all texts without words
are one group; repeated documents share their fingerprint and group; a group
whose doc_ids are all null has a null component_id; an empty table gives no
rows; other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded, free_name, materialise, slices, text_batches
from quarry.llm.components import components

SHINGLE_WORDS = 3
BITS = 2
SEED = 42
BLOCK_ROWS = 2_048
FAN_OUT = 16
TOP_NODES = 65_536
VISITORS = 200_000
_CHUNK = 4_096


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    w = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not w:
        return 0
    hash64 = xxhash.xxh64_intdigest
    if len(w) <= words:
        return hash64(b" ".join(w), SEED)
    shingles = map(b" ".join, zip(*(w[k:] for k in range(words))))
    h = np.fromiter((hash64(s, SEED) for s in shingles), np.uint64, len(w) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        bits = np.unpackbits(h[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, also: tuple = ()) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) and the columns
    ``also`` per document."""
    def run(batches):
        for b in slices(batches):
            fps = [fingerprint(t or b"", words) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)),
                 *b.columns[2:]], names=["doc_id", "fp", *also])

    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in also)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (text_batches(docs).select("doc_id", F.col("text").cast("binary").alias("text"), *also)
            .mapInArrow(run, f"doc_id {kind}, fp long{kinds}"))


def gray_rank(fp: Column) -> Column:
    """The place of a 64-bit pattern in Gray order, as a signed long that sorts
    the same way."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """A hierarchy over patterns (mask, value) given in Gray order."""

    def __init__(self, masks: np.ndarray, values: np.ndarray, fan_out: int = FAN_OUT):
        self.fan_out = fan_out
        levels = [(masks, values & masks)]
        while len(levels[-1][0]) > 1:
            m, v = levels[-1]
            at = np.arange(0, len(m), fan_out)
            agree = np.bitwise_and.reduceat(m, at)
            ones, all_ones = np.bitwise_or.reduceat(v, at), np.bitwise_and.reduceat(v, at)
            shared = agree & ~(ones ^ all_ones)
            levels.append((shared, all_ones & shared))
        self.levels = levels[::-1]
        # each node counts only the bits that its parent does not hold yet
        self.own = [self.levels[0][0]]
        for (above, _), (m, _) in zip(self.levels, self.levels[1:]):
            self.own.append(m & ~above[np.arange(len(m)) // fan_out])

    def search(self, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) places of all pairs within ``bits`` differences."""
        q = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        acc = np.zeros(len(queries), dtype=np.uint8)
        for depth, ((_, value), own) in enumerate(zip(self.levels, self.own)):
            if depth:
                q = np.repeat(q, self.fan_out)
                acc = np.repeat(acc, self.fan_out)
                node = (node[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
                there = node < len(value)
                q, acc, node = q[there], acc[there], node[there]
            acc = acc + np.bitwise_count((queries[q] ^ value[node]) & own[node])
            near = acc <= bits
            q, acc, node = q[near], acc[near], node[near]
        return q, node


class Forest:
    """Union by smallest label, whole arrays at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.up[a], self.up[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            self.flatten()

    def flatten(self) -> None:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return
            self.up = up


def _block_forest(members: np.ndarray, visitors: np.ndarray, bits: int) -> tuple:
    """Edges (fingerprint, smaller fingerprint's place holder) joining all
    fingerprints of a block and its visitors that are linked inside it.
    ``members`` are in Gray order."""
    index = GrayIndex(np.full(len(members), ~np.uint64(0)), members)
    every = np.concatenate([members, visitors])
    forest = Forest(len(every))
    for at in range(0, len(every), _CHUNK):
        q, leaf = index.search(every[at:at + _CHUNK], bits)
        forest.link(q + at, leaf)
    linked = forest.up != np.arange(len(every))
    return every[linked], every[forest.up[linked]]


def _turn(fp: Column) -> Column:
    """The two halves of the fingerprint, exchanged."""
    return F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))


def links(fps: DataFrame, bits: int = BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of
    all links. ``fps``: one row per distinct fp, read from files.

    Of two fingerprints within ``bits``, one half of the bits differs in at most
    ``bits // 2``. Two orders, with either half first, each look for such pairs:
    a fingerprint visits the blocks whose shared bits in the first half are
    that near, which grows with the logarithm of the blocks, not its square."""
    plain = _links_in_order(fps.select("fp"), bits, block_rows)
    turned = _links_in_order(fps.select(_turn(F.col("fp")).alias("fp")), bits, block_rows)
    return plain.unionByName(turned.select(_turn(F.col("a")).alias("a"), _turn(F.col("b")).alias("b")))


def _nodes(ids: np.ndarray, ones: np.ndarray, some: np.ndarray):
    """Ids and index of the patterns of blocks, by the bits that all of a block's
    members share in the first half."""
    ones, some = ones.view(np.uint64), some.view(np.uint64)
    return ids, GrayIndex(~(ones ^ some) & np.uint64(0xFFFFFFFF00000000), ones) if len(ids) else None


def _visited(nodes, fp: np.ndarray, own: np.ndarray, bits: int):
    """(places in ``fp``, ids of the nodes to visit); every pair meets in its later block."""
    ids, index = nodes
    for at in range(0, len(fp), _CHUNK):
        q, leaf = index.search(fp[at:at + _CHUNK], bits // 2)
        q += at
        later = ids[leaf] >= own[q]
        yield q[later], ids[leaf[later]]


def _parts(visitors: DataFrame, hosts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both with a column ``part``: the visitors of one ``key`` are dealt over parts of
    about ``VISITORS`` rows, and its hosts are there in each part. From files."""
    many = visitors.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > VISITORS)
    many = materialise(many.select(key, F.ceil(F.col("n") / VISITORS).cast("int").alias("parts")), "crowded")
    if many.isEmpty():
        return visitors.withColumn("part", F.lit(0)), hosts.withColumn("part", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    many = bounded(many)
    return (visitors.join(many, key, "left").withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int")).drop("parts"),
            hosts.join(many, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts"))


def _links_in_order(fps: DataFrame, bits: int, block_rows: int) -> DataFrame:
    spark = fps.sparkSession
    blocks = max(1, -(-fps.count() // block_rows))
    rank = gray_rank(F.col("fp"))
    ranged = (fps.select("fp", rank.alias("rank")).repartitionByRange(blocks, "rank")
              .sortWithinPartitions("rank")
              .select("fp", F.spark_partition_id().alias("block")))
    ranged = materialise(ranged, "gray-blocks")
    shapes = materialise(ranged.groupBy("block").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any")),
                         "block-shapes")
    run = max(1, -(-shapes.count() // TOP_NODES))  # blocks of one top node
    run_of = F.floor(F.col("block") / run).cast("int")
    tops = (shapes.groupBy(run_of.alias("top")).agg(F.bit_and("ones").alias("ones"), F.bit_or("any").alias("any"))
            .orderBy("top").toPandas())  # at most TOP_NODES rows
    shared = spark.sparkContext.broadcast(_nodes(
        tops["top"].to_numpy(), tops["ones"].to_numpy(dtype=np.int64), tops["any"].to_numpy(dtype=np.int64)))

    def visits(batches):
        for b in batches:
            fp, own = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
            for q, to in _visited(shared.value, fp, own // run, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array(fp[q].view(np.int64)), pa.array(own[q], pa.int32())],
                    names=["top", "fp", "own"])

    def inside(key: tuple, visitors: pa.Table, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("block")
        nodes = _nodes(*(blocks.column(c).to_numpy() for c in ("block", "ones", "any")))
        fp = visitors.column("fp").to_numpy().view(np.uint64)
        own = visitors.column("own").to_numpy()
        found = [(to, fp[q], to == own[q]) for q, to in _visited(nodes, fp, own, bits)]
        to, f, m = map(np.concatenate, zip(*found)) if found else (np.empty(0, int), np.empty(0, np.uint64), np.empty(0, bool))
        return pa.table({"block": pa.array(to, pa.int32()), "fp": pa.array(f.view(np.int64)), "member": pa.array(m, pa.bool_())})

    at = ranged.mapInArrow(visits, "top int, fp long, own int")
    if run == 1:
        at = at.select(F.col("top").alias("block"), "fp", (F.col("top") == F.col("own")).alias("member"))
    else:
        at = materialise(at, "run-visits")
        at, nodes = _parts(at, shapes.withColumn("top", run_of), "top")
        at = at.groupBy("top", "part").cogroup(nodes.groupBy("top", "part")).applyInArrow(
            inside, "block int, fp long, member boolean")
    at = materialise(at, "block-visits")
    visitors, members = _parts(at.where("NOT member"), at.where("member"), "block")
    at = visitors.unionByName(members)

    def forest(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy()
        member = table.column("member").to_numpy(zero_copy_only=False)
        inside = fp[member]
        r = inside.view(np.uint64).copy()
        for k in (1, 2, 4, 8, 16, 32):
            r ^= r >> np.uint64(k)
        a, b = _block_forest(inside[np.argsort(r, kind="stable")].view(np.uint64),
                             fp[~member].view(np.uint64), bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return at.groupBy("block", "part").applyInArrow(forest, "a long, b long")


def _named(prints: DataFrame, key: Column, bits: int, block_rows: int) -> DataFrame:
    """fp and first (the smallest ``key`` of its group) per distinct fingerprint.
    ``prints``: read from files."""
    classes = materialise(prints.groupBy("fp").agg(F.min(key).alias("first")), "classes")
    roots = components(links(classes, bits, block_rows))
    rooted = materialise(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return materialise(rooted.join(least, "root").select("fp", F.col("least").alias("first")), "named")


def groups(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = BITS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id of its group) per
    document."""
    prints = materialise(fingerprints(docs, words), "fingerprints")
    named = _named(prints, F.col("doc_id"), bits, block_rows)
    # from files on both sides: a fingerprint of very many documents is split
    return prints.join(named, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def fp_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = BITS,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest
    doc_id. A row is known by its doc_id and two hashes of its text, so a doc_id
    may stand for several texts: of those in one group the least hashes stay,
    and of rows equal in doc_id and text one of them. Documents without a doc_id
    go where their group has one; groups without any doc_id stay whole."""
    names = [free_name(docs, n) for n in ("_h1", "_h2")]
    id_, k1, k2 = (free_name(docs, n) for n in ("_id", "_k1", "_k2"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({names[0]: F.xxhash64(text), names[1]: F.xxhash64(F.lit(1), text)})
    plain = keyed.select("doc_id", "text", F.col(names[0]).alias("h1"), F.col(names[1]).alias("h2"))
    prints = materialise(fingerprints(plain, words, ("h1", "h2")), "fingerprints")
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h1", "h2"))
    named = _named(prints, row, bits, block_rows)
    # of each key: is it not the first of its group, or does it come twice
    rows = (prints.join(named, "fp").where("first IS NOT NULL")
            .groupBy("doc_id", "h1", "h2")
            .agg(F.count("*").alias("n"), F.max(~row.eqNullSafe(F.col("first"))).alias("gone")))
    odd = materialise(rows.where("gone OR n > 1").select(
        F.col("doc_id").alias(id_), F.col("h1").alias(k1), F.col("h2").alias(k2), "gone"),
        "near-copies")
    same = (keyed["doc_id"].eqNullSafe(odd[id_]) & (keyed[names[0]] == odd[k1])
            & (keyed[names[1]] == odd[k2]))
    kept = keyed.join(odd, same, "left_anti").select(*docs.columns)
    twice = odd.where("NOT gone")
    if twice.isEmpty():
        return kept
    once = keyed.join(twice, same, "left_semi").dropDuplicates(["doc_id", *names])
    return kept.unionByName(once.select(*docs.columns))
