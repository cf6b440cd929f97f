"""Ranked lexical search over posting lists in geometric blocks.

Documents become vectors: for each term its impact, an integer that falls with
the document's length and rises with the term's count. A query weights its
terms; a score is the sum of weight x impact.

The index is cut into segments of documents, so that a term that every document
holds is many short lists, never one long one. Within a segment each term's
posting list is clustered by document similarity: some of its documents lead,
each other one joins the leader it is most similar to (cosine of a random
projection of the weighted vectors), and runs of at most ``BLOCK`` members of one
leader are a block. A block stores its members and a summary, the greatest
impact of every term among its members, rounded up to one of ``LEVELS`` steps. Of
the terms, a summary keeps those that some query asks for together with the
list's own; no other can count in a bound.

A search takes the blocks of a query's terms, best bound first. A block's bound
is the query's score of its summary, which no member exceeds; so the blocks left
once a bound falls below the k-th best score are skipped, and the result is
exact. Members of other blocks are scored on their own vectors, each once. A few
segments are searched first; the k-th best scores found there are where all
others begin.

Sizes: queries are taken in groups whose terms are at most ``TERMS`` (one query
with more is a group of its own), and a segment holds at most ``CELLS`` documents
x terms, so that a task's matrices are bounded. Scores are sums of whole numbers
in doubles, exact below 2^53; larger ones are added as 64-bit integers.

Defined cases: a null text has no terms; documents and queries without terms take
no part; equal scores are ranked by ascending doc_id (null last); rows that share a
doc_id are ranked one by one; repeated queries are answered one by one, keyed by their
ids; empty tables give no rows; other columns are not read."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise, slices, text_batches

TERMS = 4096
CELLS = 1 << 23
BLOCK = 512
LEVELS = 255
SKETCH = 32
#: The segments of one task in so many are searched first.
FIRST_WAVE = 16
#: Queries of one group, at most.
QUERIES = 10_000
_SCALE = 10 ** 9
_TOP = 1_000_000  # impacts are below

# Every byte that is part of a term, lower-cased; the others become blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_BYTES).split()


def vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): the number of terms of each document that has
    any, and which of ``terms`` (by number) it holds how often; one row each."""
    known = docs.sparkSession.sparkContext.broadcast(terms)  # at most TERMS, or one query's
    key = docs.schema["doc_id"].dataType.simpleString()

    def count(batches):
        number = known.value
        for b in slices(batches):
            ids, n, of, counts = [], [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = terms_of(text) if text else []
                if words:
                    found = sorted((number[w], c) for w, c in Counter(words).items() if w in number)
                    ids.append(doc)
                    n.append(len(words))
                    of.append([t for t, _ in found])
                    counts.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field("doc_id").type), pa.array(n, pa.int64()),
                 pa.array(of, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    return text_batches(rows).mapInArrow(
        count, f"doc_id {key}, n long, terms array<int>, counts array<long>")


def impacts(n: np.ndarray, counts: list[np.ndarray], n_docs: int, n_terms: int) -> list[np.ndarray]:
    """Impact of each count in documents of ``n`` terms, of ``n_docs`` that have
    ``n_terms`` together."""
    out = []
    for size, c in zip(n.tolist(), counts):
        m = 100 - 90 + (90 * size * n_docs) // n_terms
        out.append((_SCALE * c) // (1000 * c + 8 * m))
    return out


class Segment:
    """Documents and the blocked posting lists of their terms."""

    def __init__(self, ids, matrix: np.ndarray, terms: np.ndarray, members: list[np.ndarray],
                 summaries: np.ndarray):
        self.ids = ids                # of the documents
        self.matrix = matrix          # documents x terms, impacts
        self.terms = terms            # of each block, ascending
        self.members = members        # of each block, rows of the matrix
        self.summaries = summaries    # blocks x terms, steps

    def search(self, of: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the ``k`` best documents among those that score at
        least ``floor`` and above 0, and how many documents were scored."""
        first = np.searchsorted(self.terms, of, "left")
        last = np.searchsorted(self.terms, of, "right")
        blocks = np.concatenate([np.arange(a, b) for a, b in zip(first, last)] or [np.empty(0, int)])
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(blocks):
            return rows, scores, 0
        step = -(-_TOP // LEVELS)
        bounds = self.summaries[np.ix_(blocks, of)].astype(weights.dtype) @ weights * step
        seen = np.zeros(len(self.ids), bool)
        least, scored = max(floor, 1), 0
        for at in np.argsort(-bounds, kind="stable"):
            if bounds[at] < least:
                break
            new = self.members[blocks[at]]
            new = new[~seen[new]]
            seen[new] = True
            scored += len(new)
            got = (self.matrix[np.ix_(new, of)].astype(weights.dtype) @ weights).astype(np.int64)
            rows = np.concatenate([rows, new[got >= least]])
            scores = np.concatenate([scores, got[got >= least]])
            if len(rows) > k:
                best = self._best(rows, scores, k)
                rows, scores = rows[best], scores[best]
            if len(rows) == k:
                least = max(least, int(scores.min()))
        best = self._best(rows, scores, k)
        return rows[best], scores[best], scored

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> list[int]:
        return sorted(range(len(rows)), key=lambda i: (
            -int(scores[i]), self.ids[rows[i]] is None, self.ids[rows[i]] or 0))[:k]


def _cluster(sketch: np.ndarray, block: int) -> list[np.ndarray]:
    """Positions of a list's documents in blocks of at most ``block``."""
    n = len(sketch)
    if n <= block:
        return [np.arange(n)]
    leaders = np.linspace(0, n - 1, -(-n // block)).astype(int)
    near = sketch @ sketch[leaders].T
    leader = near.argmax(axis=1)
    order = np.lexsort((-near[np.arange(n), leader], leader))
    cuts = np.flatnonzero(np.diff(leader[order])) + 1
    return [run[i:i + block] for run in np.split(order, cuts) for i in range(0, len(run), block)]


def together(queries: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For each term the terms that queries ask for together with it."""
    asked: dict[int, list[np.ndarray]] = {}
    for of in queries:
        for t in of.tolist():
            asked.setdefault(t, []).append(of)
    return {t: np.unique(np.concatenate(of)) for t, of in asked.items()}


def block_lists(matrix: np.ndarray, weights: np.ndarray, asked: dict[int, np.ndarray], block: int = BLOCK):
    """(term, members, coordinates, steps) of every block of a segment's lists."""
    rng = np.random.default_rng(5)
    plane = rng.standard_normal((matrix.shape[1], SKETCH)).astype(np.float32)
    sketch = matrix @ (weights[:, None] * plane)
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)
    step = -(-_TOP // LEVELS)
    steps = np.ceil(matrix / np.float32(step)).astype(np.uint8)
    docs, terms = np.nonzero(matrix)
    order = np.argsort(terms, kind="stable")
    docs, terms = docs[order], terms[order]
    starts = np.flatnonzero(np.diff(terms, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(terms)]):
        posting, wanted = docs[a:b], asked[int(terms[a])]
        for part in _cluster(sketch[posting], block):
            members = posting[part]
            most = steps[np.ix_(members, wanted)].max(axis=0)
            yield int(terms[a]), members, wanted[most > 0], most[most > 0]


def _dense(n, terms, counts, n_docs: int, n_terms: int, width: int) -> np.ndarray:
    out = np.zeros((len(terms), width), np.float32)
    for i, (t, s) in enumerate(zip(terms, impacts(n, counts, n_docs, n_terms))):
        out[i, t] = s
    return out


_INDEX = ("segment long, wave int, term int, place int, ids array<{key}>, members array<int>, "
          "at array<int>, steps array<short>")


def index(rows: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int,
          cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """The index of vectors written by ``vectors`` for queries of these terms. One row a block: term, members
    (places in the segment) and summary (terms ``at``, ``steps``); and one row a
    document, with term -1: its place and id, and its impacts (``at``, ``members``)."""
    key = rows.schema["doc_id"].dataType.simpleString()
    width = max(1, len(weights))
    per_segment = max(1, cells // width)
    shared = rows.sparkSession.sparkContext.broadcast((np.asarray(weights, np.float32), together(queries)))

    def build(batches):
        task, made, held = TaskContext.get().partitionId(), 0, []
        floats, asked = shared.value

        def finish():
            nonlocal made
            n = np.array([r[1] for r in held], np.int64)
            matrix = _dense(n, [r[2] for r in held], [r[3] for r in held], n_docs, n_terms, width)
            segment = task << 32 | made
            made += 1
            none = np.empty(0, np.int16)
            out = [(-1, i, [r[0]], matrix[i, r[2]], r[2], none) for i, r in enumerate(held)]
            out += [(t, i, [], m, at, most) for i, (t, m, at, most) in
                    enumerate(block_lists(matrix, floats, asked, block))]
            held.clear()
            wave = int(task % FIRST_WAVE > 0)
            for i in range(0, len(out), 2_000):
                part = out[i:i + 2_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment] * len(part), pa.int64()), pa.array([wave] * len(part), pa.int32()),
                     pa.array([p[0] for p in part], pa.int32()), pa.array([p[1] for p in part], pa.int32()),
                     pa.array([p[2] for p in part], pa.list_(id_type)),
                     _lists([p[3] for p in part], np.int32), _lists([p[4] for p in part], np.int32),
                     _lists([p[5] for p in part], np.int16)],
                    names=["segment", "wave", "term", "place", "ids", "members", "at", "steps"])

        for b in batches:
            id_type = b.schema.field("doc_id").type
            cut_terms, cut_counts = _arrays(b.column("terms")), _arrays(b.column("counts"))
            for row in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), cut_terms, cut_counts):
                if not len(row[2]):
                    continue
                held.append(row)
                if len(held) == per_segment:
                    yield from finish()
        if held:
            yield from finish()

    return rows.mapInArrow(build, _INDEX.format(key=key))


def _lists(parts: list[np.ndarray], dtype) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts).astype(dtype) if parts else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _arrays(column) -> list[np.ndarray]:
    """The lists of an Arrow column as views of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _load(t: pa.Table, width: int) -> Segment:
    t = t.sort_by([("term", "ascending"), ("place", "ascending")]).combine_chunks()
    term = t.column("term").to_numpy()
    n_docs = int(np.searchsorted(term, 0))
    forward, lists, term = t.slice(0, n_docs), t.slice(n_docs), term[n_docs:]
    ids = [x for one in forward.column("ids").to_pylist() for x in one]
    matrix = np.zeros((len(ids), width), np.float32)
    for i, (at, s) in enumerate(zip(_arrays(forward.column("at")), _arrays(forward.column("members")))):
        matrix[i, at] = s
    summaries = np.zeros((len(term), width), np.uint8)
    for i, (at, s) in enumerate(zip(_arrays(lists.column("at")), _arrays(lists.column("steps")))):
        summaries[i, at] = s
    return Segment(ids, matrix, term, _arrays(lists.column("members")), summaries)


def search(blocks: DataFrame, queries: list[tuple[object, np.ndarray]], weights: np.ndarray, k: int,
           floors: list[int] | None = None) -> DataFrame:
    """(query, doc_id, score, scored): the best ``k`` of each segment for each of
    ``queries`` (a number and the numbers of its terms), none below its floor;
    ``scored`` is how many documents of the segment were scored for it."""
    key = blocks.schema["ids"].dataType.elementType.simpleString()
    width = len(weights)
    total = max((int(weights[of].sum()) for _, of in queries), default=0)
    exact = np.asarray(weights, np.float64 if 2 * _TOP * total < 1 << 53 else np.int64)
    shared = blocks.sparkSession.sparkContext.broadcast((queries, exact, floors))

    def run(t: pa.Table) -> pa.Table:
        asked, w, least = shared.value
        segment = _load(t.sort_by([("term", "ascending"), ("place", "ascending")]), width)
        query, ids, scores, scored = [], [], [], []
        for i, (q, of) in enumerate(asked):
            rows, found, n = segment.search(of, w[of], k, least[i] if least else 0)
            query += [q] * len(rows)
            ids += [segment.ids[r] for r in rows]
            scores += found.tolist()
            scored += [n] * len(rows)
        return pa.table({"query": pa.array(query, pa.int64()),
                         "doc_id": pa.array(ids, t.schema.field("ids").type.value_type),
                         "score": pa.array(scores, pa.int64()), "scored": pa.array(scored, pa.int64())})

    return blocks.groupBy("segment").applyInArrow(run, f"query long, doc_id {key}, score long, scored long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query, with ``rank``."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _groups(queries: DataFrame, most: int):
    """(query, item, terms) in groups of at most ``most`` terms together."""
    group, known = [], set()
    rows = queries.select("item_id", F.col("text").cast("string").cast("binary").alias("text"))
    for i, (item, data) in enumerate(rows.toLocalIterator()):
        terms = set(terms_of(bytes(data or b"")))
        if group and (len(known | terms) > most or len(group) == QUERIES):
            yield group, known
            group, known = [], set()
        if terms:
            group.append((i, item, terms))
            known |= terms
    if group:
        yield group, known


def _weights(rows: DataFrame, width: int, n_docs: int) -> np.ndarray:
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    out = np.zeros(width, np.int64)
    for term, df in held:  # one row a term
        out[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return out


def rank(docs: DataFrame, queries: DataFrame, k: int = 10, most_terms: int = TERMS,
         cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents (doc_id, text) that
    score highest, above 0, for each of ``queries`` (item_id, text)."""
    spark = docs.sparkSession
    item, doc = (d.schema[c].dataType.simpleString() for d, c in ((queries, "item_id"), (docs, "doc_id")))
    out = spark.createDataFrame([], f"item_id {item}, rank int, doc_id {doc}, score long")
    for group, known in _groups(queries, most_terms):
        number = {t: i for i, t in enumerate(sorted(known))}
        rows = materialise(vectors(docs, number), "term-vectors")
        n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            return out
        weights = _weights(rows, len(number), n_docs)
        asked = [(q, np.array(sorted(number[t] for t in terms), np.int64)) for q, _, terms in group]
        blocks = materialise(index(rows, [of for _, of in asked], weights, n_docs, n_terms, cells, block),
                             "term-blocks")
        first = materialise(best(search(blocks.where("wave = 0"), asked, weights, k), k), "first-wave")
        floor = {q: s for q, s in first.where(F.col("rank") == k).select("query", "score").collect()}
        others = search(blocks.where("wave = 1"), asked, weights, k, [floor.get(q, 0) for q, _ in asked])
        names = spark.createDataFrame([(q, i) for q, i, _ in group], f"query long, item_id {item}")
        ranked = best(first.drop("rank").unionByName(others), k)
        out = out.unionByName(ranked.join(F.broadcast(names), "query").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
