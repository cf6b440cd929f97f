"""Inverted lists of vectors (Q10) beyond a fixed number of probes.

``exact``: every list has a radius, the greatest angle between its centroid and
a member. The angle between a query and any member is at least (angle to the
centroid) - radius, so a query takes its lists by that bound and stops when its
k-th best is nearer than every unread list can be. The result is exact; how many
lists it read is reported.

``coded``: members are stored as codes. A member's residual (itself less its
list's centroid) is cut into subspaces, and each part is replaced by the nearest
of that subspace's codewords, fitted by k-means in Spark. A search scores the
codes of the probed lists by a table of products per query, and the best
``rerank`` by codes are scored again on the vectors themselves.

Both join queries and members by list: a query is compared with what it reaches
and nothing else. Distances are cosine distances; vectors without direction
(zero, null) are in no list, and queries without one get no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.util import slices
from quarry.operators.ann import CELLS, _Best, asked_rows, list_candidates, query_blocks, top_per_query, wanted_rows
from quarry.operators.graph import directed, unit_matrix
from quarry.session import scratch_path

SUBSPACES = 8
CODEWORDS = 256
#: Vectors that codewords and centroids are fitted on, at most about; every
#: vector is coded and listed.
FIT_ROWS = 200_000
FIT_ROUNDS = 10
CENTROID_ROUNDS = 20
SEED_ROWS = 16      # vectors a list that its first centroid is drawn from
FIT_SLICE = 2_048   # vectors compared with all centroids at a time
#: Bounds (queries x lists) on the driver at a time.
BOUNDS = 1 << 26
#: Added to bounds: far above the rounding of 4-byte vectors.
SLACK = 1e-5


def _sample(points: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` rows, written once and dealt to one part a core."""
    n = points.count()
    share = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = points if n <= most else points.where(share < most / n)
    spark = points.sparkSession
    parts, path = spark.sparkContext.defaultParallelism, scratch_path(spark, "fit-sample")
    some.repartition(parts, "id").write.parquet(path)
    return spark.read.parquet(path).coalesce(parts)


def _first(sample: DataFrame, most: int, seed: int) -> DataFrame:
    return sample.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(most)


def _rounds(sample: DataFrame, words: list[np.ndarray], rounds: int, parts_of) -> list[np.ndarray]:
    """``rounds`` of k-means from ``words``, one array a subspace, in one pass each:
    ``parts_of`` makes a batch's points, one matrix a subspace. Sums by codeword are
    one row a task; a codeword that nothing is near stays."""
    sc = sample.sparkSession.sparkContext
    for _ in range(rounds if all(map(len, words)) else 0):
        shared = sc.broadcast(words)

        def sums(batches):
            held = shared.value
            total = [np.zeros((len(w), w.shape[1] + 1)) for w in held]
            for b in slices(batches, FIT_SLICE):
                for i, part in enumerate(parts_of(b)):
                    near = ((held[i] ** 2).sum(axis=1) - 2 * part @ held[i].T).argmin(axis=1)
                    order = np.argsort(near, kind="stable")
                    used, start = np.unique(near[order], return_index=True)
                    total[i][used] += np.add.reduceat(np.c_[part, np.ones(len(part))][order], start, axis=0)
            yield pa.RecordBatch.from_pydict({"x": [t.tobytes() for t in total], "s": list(range(len(total)))},
                                             schema=pa.schema([("x", pa.binary()), ("s", pa.int32())]))

        total = [np.zeros((len(w), w.shape[1] + 1)) for w in words]
        for r in sample.mapInArrow(sums, "x binary, s int").collect():  # a task: subspaces x codewords x their width
            total[r.s] += np.frombuffer(r.x).reshape(total[r.s].shape)
        shared.unpersist()
        old, words = words, [np.where(t[:, -1:] > 0, t[:, :-1] / np.maximum(t[:, -1:], 1), w)
                             for t, w in zip(total, words)]
        if all(np.allclose(a, b, rtol=0, atol=1e-4) for a, b in zip(old, words)):
            break
    return words


def _fit_centroids(sample: DataFrame, lists: int, seed: int) -> np.ndarray:
    """Unit centroids by k-means: seeds drawn by k-means++ from ``SEED_ROWS`` vectors
    a list, rounds in Spark over the whole sample."""
    rows = _first(sample, lists * SEED_ROWS, seed).select("v").collect()
    if not rows:
        return np.zeros((0, 1))
    m = np.array([r.v for r in rows], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    picked, far = [int(rng.integers(len(m)))], np.full(len(m), np.inf)
    while len(picked) < lists:
        far = np.minimum(far, np.maximum(1 - m @ m[picked[-1]], 0))
        reach = np.cumsum(np.where(far > 1e-9, far, 0))  # a copy of a seed is none
        if reach[-1] <= 0:
            break
        picked.append(min(int(np.searchsorted(reach, rng.random() * reach[-1], side="right")), len(m) - 1))
    cents = _rounds(sample, [m[picked]], CENTROID_ROUNDS, lambda b: [unit_matrix(b.column(1))])[0]
    return cents / np.maximum(np.linalg.norm(cents, axis=1, keepdims=True), 1e-30)


def build(vectors: DataFrame, path: str, lists: int, id_col: str = "id", vec_col: str = "embedding",
          subspaces: int = 0, codewords: int = CODEWORDS, seed: int = 7) -> "Lists":
    """Write vectors sorted by list to ``path`` (with ``subspaces``, their codes too);
    centroids, radii, sizes and codewords are small and returned. A list's rows stand
    together and a large list is in several files: how many files there are follows
    the rows, not the lists, and a reader skips the pages of other lists."""
    points = directed(vectors, id_col, vec_col)
    cents = _fit_centroids(_sample(points.select("id", F.col("v").cast("array<float>").alias("v")), FIT_ROWS),
                           int(lists), seed)
    shared = points.sparkSession.sparkContext.broadcast(cents)

    def assign(batches):
        for b in slices(batches, FIT_SLICE):
            m = unit_matrix(b.column(1))
            sims = m @ shared.value.T
            at = sims.argmax(axis=1) if len(m) else np.empty(0, int)
            angle = np.arccos(np.clip(sims[np.arange(len(m)), at], -1, 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(at.astype(np.int32)), pa.array(angle)],
                names=["id", "v", "list_id", "angle"])

    listed = points.mapInArrow(assign, "id long, v array<float>, list_id int, angle double")
    spark = points.sparkSession
    plain = scratch_path(spark, "lists")
    listed.write.parquet(plain)
    listed = spark.read.parquet(plain)
    radii, sizes = np.zeros(len(cents)), np.zeros(len(cents), np.int64)
    for r in listed.groupBy("list_id").agg(F.max("angle").alias("r"), F.count("*").alias("n")).collect():
        radii[r.list_id], sizes[r.list_id] = r.r, r.n
    words = _fit_codewords(listed, cents, subspaces, codewords, seed) if subspaces else None
    by_list = (listed.select("id", "v", "list_id").repartitionByRange("list_id", F.xxhash64("id"))
               .sortWithinPartitions("list_id", "id"))
    (by_list if words is None else _encode(by_list, cents, words)).write.mode("overwrite").parquet(path)
    return Lists(path, cents, radii, words, sizes)


class Lists:
    """Where the lists are, their centroids (unit), radii and sizes, and the codewords."""

    def __init__(self, path: str, centroids: np.ndarray, radii: np.ndarray, words: list[np.ndarray] | None,
                 sizes: np.ndarray):
        self.path, self.centroids, self.radii, self.words, self.sizes = path, centroids, radii, words, sizes


# --- exact search with early stop ------------------------------------------------
def _query_blocks(queries: DataFrame, n_lists: int):
    """Query vectors on the driver, a block of bounded size at a time: ids, vectors
    and unit vectors."""
    asked = directed(queries, "qid").select(F.col("id").alias("qid"), F.col("v").alias("embedding"))
    for rows in query_blocks(asked, ["qid", "embedding"], "qid"):
        most = max(1, BOUNDS // max(1, n_lists))
        for at in range(0, len(rows), most):
            part = rows[at:at + most]
            q = np.array([r[1] for r in part], np.float64)
            yield np.array([r[0] for r in part], np.int64), q, q / np.linalg.norm(q, axis=1, keepdims=True)


def _bounds(unit: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Each query's lists by their bound, and those bounds in that order, in 4 bytes
    each and rounded down."""
    order = np.empty((len(unit), len(lists.centroids)), np.int32)
    bound = np.empty(order.shape, np.float32)
    for at in range(0, len(unit), 1024):
        angle = np.arccos(np.clip(unit[at:at + 1024] @ lists.centroids.T, -1, 1))
        low = 1 - np.cos(np.clip(angle - lists.radii - SLACK, 0, np.pi))
        order[at:at + 1024] = by = np.argsort(low, axis=1, kind="stable")
        bound[at:at + 1024] = np.take_along_axis(low, by, axis=1) - 1e-6
    return order, bound


def _wanted(lists_of: np.ndarray, rows: np.ndarray, n: int, n_lists: int) -> dict[int, np.ndarray]:
    """List to those of ``n`` queries that want it, from pairs of list and query."""
    by = np.argsort(lists_of, kind="stable")
    lists_of, rows = lists_of[by], rows[by]
    cuts, want = np.searchsorted(lists_of, np.arange(n_lists + 1)), {}
    for one in np.unique(lists_of).tolist():
        mask = np.zeros(n, bool)
        mask[rows[cuts[one]:cuts[one + 1]]] = True
        want[one] = wanted_rows(mask)
    return want


def exact(spark: SparkSession, lists: Lists, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of every query (qid, embedding): (qid, id, dist, rank,
    lists_read). Lists are read in waves, each query twice as many in every wave
    as in the one before, as long as their bounds allow; of a wave, tasks put out
    only what is no farther than the query's k-th best so far."""
    t = spark.read.parquet(lists.path)
    n_lists, out = len(lists.centroids), None
    for qids, qmat, unit in _query_blocks(queries, n_lists):
        by_id = np.argsort(qids)
        qids, qmat, unit = qids[by_id], qmat[by_id], unit[by_id]
        order, bound = _bounds(unit, lists)
        read, going, start, wave = np.zeros(len(qids), int), np.arange(len(qids)), 0, 1
        kth, found = np.full(len(qids), np.inf), None
        while len(going):  # all that go on have read as many
            some = slice(start, start + wave)
            ok = bound[going, some] <= kth[going, None] + SLACK
            rows = np.broadcast_to(going[:, None].astype(np.int32), ok.shape)[ok]
            read[going] += ok.sum(axis=1)
            want = _wanted(order[going, some][ok], rows, len(qids), n_lists)
            part = list_candidates(t, want, qmat, qids, k, vec_col="v", far=kth)
            part = part if found is None else found.select("qid", "id", "dist").unionByName(part)
            path = scratch_path(spark, "list-wave")
            top_per_query(part, k).write.parquet(path)
            found = spark.read.parquet(path)
            last = found.where(F.col("rank") == k).select("qid", "dist").toArrow()
            kth[np.searchsorted(qids, last.column("qid").to_numpy())] = last.column("dist").to_numpy()
            start, wave = start + wave, 2 * wave
            going = going[bound[going, start] <= kth[going] + SLACK] if start < n_lists else going[:0]
        counts = spark.createDataFrame([(int(q), int(n)) for q, n in zip(qids, read)], "qid long, lists_read int")
        found = found.join(F.broadcast(counts), "qid").select("qid", "id", "dist", "rank", "lists_read")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame(
        [], "qid long, id long, dist double, rank int, lists_read int")


# --- codes ---------------------------------------------------------------------
def _residual_parts(m: np.ndarray, at: np.ndarray, cents: np.ndarray, subspaces: int) -> list[np.ndarray]:
    return np.array_split(m - cents[at], subspaces, axis=1)


def _fit_codewords(listed: DataFrame, cents: np.ndarray, subspaces: int, codewords: int, seed: int) -> list[np.ndarray]:
    """Codewords of each subspace: k-means on the residuals of a sample, all
    subspaces in one pass a round."""
    sample = _sample(listed.select("id", "v", "list_id"), FIT_ROWS)
    first = _first(sample, codewords, seed).collect()
    if not first:
        return []
    m, at = np.array([r.v for r in first], np.float64), np.array([r.list_id for r in first])
    words = _residual_parts(m / np.linalg.norm(m, axis=1, keepdims=True), at, cents, subspaces)
    return _rounds(sample, words, FIT_ROUNDS, lambda b: _residual_parts(
        unit_matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False), cents, subspaces))


def _encode(listed: DataFrame, cents: np.ndarray, words: list[np.ndarray]) -> DataFrame:
    shared = listed.sparkSession.sparkContext.broadcast((words, cents))

    def run(batches):
        held, c = shared.value
        for b in batches:
            m, at = unit_matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)
            codes = np.empty((len(m), len(held)), np.uint8)
            for i, part in enumerate(_residual_parts(m, at, c, len(held))):
                codes[:, i] = ((held[i] ** 2).sum(axis=1) - 2 * part @ held[i].T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([r.tobytes() for r in codes], pa.binary())], [*b.schema.names, "code"])

    return listed.mapInArrow(run, "id long, v array<float>, list_id int, code binary")


def coded(spark: SparkSession, lists: Lists, queries: DataFrame, k: int, probes: int, rerank: int) -> DataFrame:
    """The ``k`` nearest found by codes in ``probes`` lists, the best ``rerank`` of them
    scored on their vectors: (qid, id, dist, rank, coded, scored). ``coded`` and
    ``scored`` are how many codes and how many vectors the query was compared with.

    A query's nearest lists, as many as hold ``rerank`` members, are read first; of
    the others, tasks put out only codes no farther than its best ``rerank`` so far."""
    t, out = spark.read.parquet(lists.path), None
    n_lists, cents, words = len(lists.centroids), lists.centroids, lists.words
    for qids, qmat, unit in _query_blocks(queries, n_lists):
        by_id = np.argsort(qids)
        qids, qmat, unit = qids[by_id], qmat[by_id], unit[by_id]
        near = np.empty((len(qids), min(probes, n_lists)), np.int32)
        for at in range(0, len(qids), 1024):
            near[at:at + 1024] = np.argsort(-(unit[at:at + 1024] @ cents.T), axis=1, kind="stable")[:, :probes]
        size = lists.sizes[near]
        first = np.cumsum(size, axis=1) - size < rerank  # the lists before hold fewer
        rows = np.broadcast_to(np.arange(len(qids), dtype=np.int32)[:, None], near.shape)
        far, codes = np.full(len(qids), np.inf), None
        for some in (first, ~first):
            if not some.any():
                continue
            want = _wanted(near[some], rows[some], len(qids), n_lists)
            part = _code_candidates(t, want, unit, qids, rerank, cents, words, far)
            part = part if codes is None else codes.unionByName(part)
            path = scratch_path(spark, "coded")
            top_per_query(part, rerank).write.parquet(path)
            codes = spark.read.parquet(path).select("qid", "id", "dist", "rank")
            last = codes.where(F.col("rank") == rerank).select("qid", "dist").toArrow()
            far[np.searchsorted(qids, last.column("qid").to_numpy())] = last.column("dist").to_numpy()
            codes = codes.drop("rank")
        chosen = codes.select("qid", "id")
        shared = spark.sparkContext.broadcast((qids, qmat))

        def score(batches, shared=shared):
            names, q = shared.value
            for b in slices(batches, FIT_SLICE):
                asked = b.column(0).to_numpy(zero_copy_only=False)
                own = q[np.searchsorted(names, asked)]
                own = own / np.linalg.norm(own, axis=1, keepdims=True)
                d = 1.0 - np.einsum("ij,ij->i", unit_matrix(b.column(2)), own)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d)], ["qid", "id", "dist"])

        scored = (chosen.join(t.select("id", "v"), "id").select("qid", "id", "v")
                  .mapInArrow(score, "qid long, id long, dist double"))
        read = spark.createDataFrame([(int(q), int(n)) for q, n in zip(qids, size.sum(axis=1))], "qid long, coded long")
        n = chosen.groupBy("qid").agg(F.count("*").alias("scored"))
        part = (top_per_query(scored, k).join(F.broadcast(read), "qid").join(n, "qid")
                .select("qid", "id", "dist", "rank", "coded", "scored"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame(
        [], "qid long, id long, dist double, rank int, coded long, scored long")


def _code_candidates(table: DataFrame, want: dict[int, np.ndarray], unit: np.ndarray, qids: np.ndarray, k: int,
                     cents: np.ndarray, words: list[np.ndarray], far: np.ndarray) -> DataFrame:
    """``list_candidates`` by codes: the product of a query with a member's codewords
    and its list's centroid, summed once per member, not once per member and query."""
    shared = table.sparkSession.sparkContext.broadcast((want, unit, qids, far, cents, words))

    def run(batches):
        wanted, q, names, most, c, held = shared.value
        best = _Best(len(names), k, most)
        for b in slices(batches, FIT_SLICE):
            ids, at = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            code = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
            m = c[at] + np.concatenate([w[code[:, s]] for s, w in enumerate(held)], axis=1)
            for one in np.unique(at):
                asked, rows = asked_rows(wanted.get(int(one)), len(names)), np.flatnonzero(at == one)
                if asked is None:
                    continue
                for s0 in range(0, len(asked), 512):
                    some = asked[s0:s0 + 512]
                    d = 1 - q[some] @ m[rows].T
                    best.offer(some, np.zeros(d.shape, np.int8), d, ids[rows])
        i, _, d, w = best.rows()
        for cut in (slice(x, x + CELLS) for x in range(0, len(i), CELLS)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[i[cut]]), pa.array(w[cut]), pa.array(d[cut])], ["qid", "id", "dist"])

    return (table.where(F.col("list_id").isin(sorted(want))).select("id", "list_id", "code")
            .mapInArrow(run, "qid long, id long, dist double"))
