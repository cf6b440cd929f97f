"""Nearest neighbours by a block matrix join of int8 tiles.

Vectors are scaled to length one and quantised to int8 with one scale each; the
length of what the quantisation lost is kept. A tile is the product of a block
of queries with a block of candidates in int8 (exact whole numbers), which gives
each pair an interval that holds its true cosine. A pair survives if its upper
end reaches what its query is sure to get: the k-th best lower end of the tile,
or the k-th best exact score so far. Survivors are computed again in double
precision on the original vectors and merged by heaps of k per query. The
result is exact.

Queries are taken in blocks of at most ``block_bytes``, one broadcast and one
pass over the candidates each; a task gives out k rows per query. Of equal
vectors in a tile only the k + 1 with the smallest ids can be among the nearest
of any query, so a vector with very many copies costs no more.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; only vectors of equal length are compared; rows that
share an id are one candidate, by the best of their scores, and one query, by
the smallest of their vectors; null ids take no part; a query with fewer than k
candidates gets them all; other columns are not read."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise

BLOCK_BYTES = 16 << 20
TILE_ROWS = 2_048
_EXACT_DIMS = 1_024  # 127 * 127 * 1024 < 2**24: whole numbers in single precision
_PAIRS = 32_768
_SLACK = 1e-6  # over the rounding of the bounds themselves


def takes_part(vector: Column) -> Column:
    """The vector is finite and not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


class Block:
    """Ids and vectors of one length, with their int8 form."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        # a common factor changes no cosine; it keeps squares in range
        top = np.abs(vectors).max(axis=1, keepdims=True)
        squares = (vectors * vectors).sum(axis=1, keepdims=True)
        out_of_range = ~((squares > 1e-200) & (squares < 1e200))
        self.vectors = np.where(out_of_range, vectors / top, vectors)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        unit = self.vectors / self.norms[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.int8 = np.rint(unit / self.scale[:, None]).astype(np.int8)
        approx = self.int8 * self.scale[:, None]
        self.lost = np.sqrt(((unit - approx) ** 2).sum(axis=1))
        self.length = np.sqrt((approx ** 2).sum(axis=1))

    def part(self, at) -> Block:
        out = object.__new__(Block)
        for name, value in self.__dict__.items():
            setattr(out, name, value[at])
        return out

    def bounds(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the cosines of all pairs."""
        dot = np.zeros((len(self.ids), len(other.ids)))
        for at in range(0, self.int8.shape[1], _EXACT_DIMS):
            dot += (self.int8[:, at:at + _EXACT_DIMS].astype(np.float32)
                    @ other.int8[:, at:at + _EXACT_DIMS].astype(np.float32).T)
        dot *= self.scale[:, None] * other.scale
        wide = self.lost[:, None] * other.length + other.lost + _SLACK
        return dot - wide, dot + wide

    def cosines(self, other: Block, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.empty(len(q))
        for at in range(0, len(q), _PAIRS):
            i, j = q[at:at + _PAIRS], c[at:at + _PAIRS]
            out[at:at + _PAIRS] = ((self.vectors[i] * other.vectors[j]).sum(axis=1)
                                   / (self.norms[i] * other.norms[j]))
        return out


class Heaps:
    """The k best (score, smaller id first) per query, each id once."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.held: list[dict[int, float]] = [{} for _ in queries.ids]
        self.floor = np.full(len(queries.ids), -np.inf)

    def push(self, q: int, score: float, vec_id: int) -> None:
        heap, held, entry = self.heaps[q], self.held[q], (score, -vec_id)
        if vec_id in held:
            if score <= held[vec_id]:
                return
            heap.remove((held[vec_id], -vec_id))
            heapq.heapify(heap)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            _, gone = heapq.heapreplace(heap, entry)
            del held[-gone]
        else:
            return
        held[vec_id] = score
        if len(heap) == self.k:
            self.floor[q] = heap[0][0]

    def tile(self, c: Block, unique: bool) -> None:
        """Merge a block of candidates; ``unique``: no id occurs twice in it."""
        low, high = self.queries.bounds(c)
        own = self.queries.ids[:, None] == c.ids
        high[own] = -np.inf
        sure = self.floor
        if unique and low.shape[1] > self.k:
            low[own] = -np.inf
            kth = np.partition(low, low.shape[1] - self.k, axis=1)[:, low.shape[1] - self.k]
            sure = np.maximum(sure, kth)
        q, j = np.nonzero((high >= sure[:, None]) & ~own)
        for a, b, s in zip(q.tolist(), c.ids[j].tolist(),
                           self.queries.cosines(c, q, j).tolist()):
            self.push(a, s, b)


def fewest_copies(ids: np.ndarray, vectors: np.ndarray, keep: int):
    """Rows with the ``keep`` smallest ids of each distinct vector; an id once."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors[0].nbytes))).ravel()
    _, group = np.unique(rows, return_inverse=True)
    by = np.lexsort((ids, group))
    g, i = group[by], ids[by]
    first = np.concatenate(([True], (g[1:] != g[:-1]) | (i[1:] != i[:-1])))
    by, g = by[first], g[first]
    start = np.concatenate(([True], g[1:] != g[:-1]))
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(start, np.arange(len(g)), 0))
    kept = by[rank < keep]
    return ids[kept], vectors[kept]


def _blocks(batch, sizes=None):
    """(dimension, ids, vectors) of a record batch of (id, vector)."""
    lists = batch.column(1)
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.values.slice(lists.offsets[0].as_py(), int(n.sum())).to_numpy(
        zero_copy_only=False).astype(np.float64)
    ids, start = batch.column(0).to_numpy(zero_copy_only=False), np.cumsum(n) - n
    for d in np.unique(n):
        if sizes is None or d in sizes:
            at = np.flatnonzero(n == d)
            yield int(d), ids[at], flat[start[at][:, None] + np.arange(d)]


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest cosine for each
    query but itself. Both sides are (id, vector) tables."""
    spark = candidates.sparkSession
    vector = F.col(vector_col).cast("array<double>")

    def valid(df):
        return df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).where(
            F.col("id").isNotNull() & takes_part(F.col("v")))

    asked = materialise(valid(queries).groupBy("id").agg(F.min("v").alias("v")), "ann-queries")
    size = asked.agg(F.sum(8 * F.size("v") + 16)).first()[0] or 0
    n_blocks = max(1, -(-int(size) // block_bytes))
    rows = valid(candidates)
    found = None
    for b in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b)
        shared = spark.sparkContext.broadcast(
            {d: (ids, v) for batch in part.toArrow().combine_chunks().to_batches()
             for d, ids, v in _blocks(batch)})
        best = rows.mapInArrow(_search(shared, k), "query_id long, vec_id long, score double")
        best = best if n_blocks == 1 else materialise(best, "ann-block")
        found = best if found is None else found.unionByName(best)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search(shared, k):
    def run(batches):
        heaps = {d: Heaps(Block(ids, v), k) for d, (ids, v) in shared.value.items()}
        for batch in batches:
            for d, ids, v in _blocks(batch, heaps):
                ids, v = fewest_copies(ids, v, k + 1)
                block = Block(ids, v)
                unique = len(np.unique(ids)) == len(ids)
                for at in range(0, len(ids), TILE_ROWS):
                    heaps[d].tile(block.part(slice(at, at + TILE_ROWS)), unique)
        for h in heaps.values():
            out = [(q, -i, s) for q, heap in zip(h.queries.ids.tolist(), h.heaps) for s, i in heap]
            q, i, s = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())],
                names=["query_id", "vec_id", "score"])
    return run
