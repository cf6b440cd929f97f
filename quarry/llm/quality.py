"""Quality classifier: a linear-chain conditional random field over lines.

Each line of a document (parts between line feeds) gets a label, good or bad.
Its features are counts of character classes as shares of its length, word
statistics and repetition, each together with the same features of the line
before and after it. Weights for the features and for the four transitions are
learned from documents whose label all their lines take over. A document's
score is the length-weighted mean of its lines' forward-backward marginals of
"good".

Learning uses a documented, bounded sample: about ``sample_docs`` labelled
doc_ids by their hash, one text of each, in the order of their hashes until
``sample_lines`` lines are taken. A longer text than ``chunk_lines`` teaches by that many
consecutive lines, begun at a place that its hash picks. Scoring reads every
whole text. Texts of over ``chunk_lines`` lines are read in chunks of lines, and their
chain is cut into about as many parts as each has lines: all parts' products of
transitions at once, then the parts' ends, then all marginals at once.

Defined cases: null text counts as empty; an empty text is one empty line and
gets a score like any other; a doc_id with several labels counts as its largest
label, null labels don't count; a doc_id with several texts teaches by the one with
the least hash; without any label every score is 0.5; repeated documents are
scored one by one; other columns pass through unread."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import free_name, materialise, slices, text_batches

SAMPLE_DOCS = 4_000
SAMPLE_LINES = 200_000  # features of all of them are on the driver
CHUNK_LINES = 4_096
STEPS = 300
RATE = 0.1
DECAY = 1e-3
_PIECE = 1 << 20  # bytes of text whose characters are counted at once
_NEVER = -1e30  # log of nothing

# character classes of a byte
_CLASSES = 16
_CLASS = np.full(256, 15, dtype=np.int64)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
for _k, _chars in enumerate(("." , ",;:", "!?", "|", "\"'", "()[]{}<>", "-_=+", "*#%&$@~^",
                             "/\\"), start=4):
    _CLASS[[ord(c) for c in _chars]] = _k
_CLASS[0x80:0xC0] = 13
_CLASS[0xC0:] = 14
BASE = _CLASSES + 7
WIDTH = 3 * BASE + 1


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of some texts, the lines' weights (bytes plus one)
    and the number of lines of each text."""
    counts, words, n_lines = [], [], []
    piece, size = [], 0
    for text in texts:
        lines = text.split(b"\n")
        n_lines.append(len(lines))
        words += _line_words(lines, set(), None)
        piece.append(text)
        size += len(text) + 1
        if size > _PIECE:
            counts.append(_class_counts(piece))
            piece, size = [], 0
    if piece:
        counts.append(_class_counts(piece))
    base, length = _base(np.concatenate(counts), words)
    first = np.cumsum([0, *n_lines[:-1]])
    up, down = np.zeros_like(base), np.zeros_like(base)
    up[1:], down[:-1] = base[:-1], base[1:]
    up[first] = 0
    down[first + np.array(n_lines) - 1] = 0
    x = np.column_stack([np.ones(len(base)), base, up, down])
    return x, length + 1, np.array(n_lines)


def _line_words(lines: list[bytes], seen: set, before: bytes | None) -> list[tuple]:
    """Word statistics of lines in a row; ``seen`` holds those before them."""
    out = []
    for line in lines:
        w = line.split()
        out.append((len(w), len(set(w)), line in seen, line == before, max(map(len, w), default=0)))
        seen.add(line)
        before = line
    return out


def _base(counts: np.ndarray, words: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line by itself, and the lines' lengths."""
    c = counts.astype(np.float64)
    length = c.sum(axis=1)
    some = np.maximum(length, 1)[:, None]
    n, distinct, seen, again, longest = np.array(words, dtype=np.float64).T
    return np.column_stack([
        np.sqrt(c / some), np.log1p(length), np.log1p(n), distinct / np.maximum(n, 1),
        np.log1p(n - distinct), length / (n + 1) / 10, np.minimum(longest, 100) / 10,
        np.maximum(seen, again)]), length


def chunk_features(text: bytes, chunk: int = CHUNK_LINES):
    """What ``line_features`` gives for one text, for about ``chunk`` lines at a time:
    features and lengths plus one."""
    lines, seen, before = text.split(b"\n"), set(), None
    held, weight, up, none = None, None, np.zeros((1, BASE)), np.zeros((1, BASE))
    for at in range(0, len(lines), chunk):
        part = lines[at:at + chunk]
        base, length = _base(_class_counts([b"\n".join(part)]), _line_words(part, seen, before))
        before = part[-1]
        if held is not None:
            yield _with_neighbours(held, up, base[:1]), weight
            up = held[-1:]
        held, weight = base, length + 1
    yield _with_neighbours(held, up, none), weight


def _with_neighbours(base: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(base)), base, np.concatenate([up, base[:-1]]),
                            np.concatenate([base[1:], down])])


def _class_counts(texts: list[bytes]) -> np.ndarray:
    """Characters of each class in each line of the joined texts."""
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    line = np.zeros(len(data), dtype=np.int64)
    line[ends[ends + 1 < len(data)] + 1] = 1
    n = len(ends) + 1
    key = np.cumsum(line) * _CLASSES + _CLASS[data]
    out = np.bincount(key, minlength=n * _CLASSES).reshape(n, _CLASSES)
    out[:len(ends), 15] -= 1  # the line feed itself
    return out


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Chains:
    """Forward-backward over chains of unequal length, one step of all chains
    at a time; the longest first, so that those still running are a prefix."""

    def __init__(self, n_lines: np.ndarray):
        self.order = np.argsort(-n_lines, kind="stable")
        self.n = n_lines[self.order]
        self.first = (np.cumsum(n_lines) - n_lines)[self.order]
        self.alive = np.searchsorted(-self.n, -np.arange(self.n[0] if len(self.n) else 0), "left")

    def marginals(self, emit: np.ndarray, move: np.ndarray):
        """Per line P(bad), P(good); log Z per chain (in ``order``); expected
        transition counts. ``emit``: the lines' scores for good; ``move``: 2x2."""
        score = np.column_stack([np.zeros(len(emit)), emit])
        alpha = np.empty_like(score)
        beta = np.zeros_like(score)
        for t, m in enumerate(self.alive):
            at = self.first[:m] + t
            if t == 0:
                alpha[at] = score[at]
            else:
                alpha[at] = score[at] + _logsumexp(alpha[at - 1][:, :, None] + move, 1)
        last = self.first + self.n - 1
        z = _logsumexp(alpha[last], 1)
        pairs = np.zeros((2, 2))
        for t in range(len(self.alive) - 1, 0, -1):
            m = self.alive[t]
            at = self.first[:m] + t
            ahead = move + (score[at] + beta[at])[:, None, :]
            beta[at - 1] = _logsumexp(ahead, 2)
            pairs += np.exp(alpha[at - 1][:, :, None] + ahead - z[:m, None, None]).sum(axis=0)
        p = alpha + beta
        p = np.exp(p - _logsumexp(p, 1)[:, None])
        return p, z, pairs


def long_marginals(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(good) of every line of one chain: ``Chains.marginals`` in about twice the
    square root of its length in steps."""
    n = len(emit)
    width = int(np.ceil(np.sqrt(n)))
    parts = -(-n // width)
    score = np.zeros((parts * width, 2))
    score[:n, 1] = emit
    score = score.reshape(parts, width, 2)
    there = (np.arange(parts * width) < n).reshape(parts, width)
    # log products of the transitions of every part, from the state before it
    start = np.broadcast_to(move, (parts, 2, 2)).copy()
    start[0] = [[0, 0], [_NEVER, _NEVER]]
    prod = start + score[:, 0, None, :]
    for t in range(1, width):
        step = _logsumexp(prod[:, :, :, None] + move, 2) + score[:, t, None, :]
        prod = np.where(there[:, t, None, None], step, prod)
    into, after = np.zeros((parts, 2)), np.zeros((parts, 2))
    into[0] = [0, _NEVER]
    for k in range(1, parts):
        into[k] = _logsumexp(into[k - 1][:, None] + prod[k - 1], 0)
    for k in range(parts - 1, 0, -1):
        after[k - 1] = _logsumexp(prod[k] + after[k], 1)
    alpha, beta = np.zeros((parts, width, 2)), np.zeros((parts, width, 2))
    state = _logsumexp(into[:, :, None] + start, 1) + score[:, 0]
    for t in range(width):
        if t:
            state = _logsumexp(state[:, :, None] + move, 1) + score[:, t]
        alpha[:, t] = state
    state = after.copy()
    for t in range(width - 1, -1, -1):
        beta[:, t] = state
        back = _logsumexp(move + (score[:, t] + state)[:, None, :], 2)
        state = np.where(there[:, t, None], back, state)
    p = (alpha + beta).reshape(-1, 2)[:n]
    return np.exp(p - _logsumexp(p, 1)[:, None])[:, 1]


class Model:
    """Scaling, feature weights and transitions."""

    def __init__(self, mean, spread, weights, move):
        self.mean, self.spread, self.weights, self.move = mean, spread, weights, move

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -5, 5)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        long = np.array([t.count(b"\n") >= CHUNK_LINES for t in texts])
        if long.any():
            out = np.empty(len(texts))
            out[long] = [self._long(t) for t, is_long in zip(texts, long) if is_long]
            out[~long] = self.scores([t for t, is_long in zip(texts, long) if not is_long])
            return out
        x, weight, n_lines = line_features(texts)
        p, _, _ = Chains(n_lines).marginals(self.scaled(x) @ self.weights, self.move)
        first = np.cumsum(n_lines) - n_lines
        good = np.add.reduceat(p[:, 1] * weight, first) / np.add.reduceat(weight, first)
        return np.clip(good, 0.0, 1.0)

    def _long(self, text: bytes) -> float:
        emit, weight = zip(*((self.scaled(x) @ self.weights, w) for x, w in chunk_features(text)))
        weight = np.concatenate(weight)
        good = long_marginals(np.concatenate(emit), self.move) @ weight / weight.sum()
        return float(np.clip(good, 0.0, 1.0))


def fit(x: np.ndarray, n_lines: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood of the chains' labels, by Adam with weight decay."""
    if not len(label):
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)))
    mean, spread = x.mean(axis=0), x.std(axis=0)
    mean[0], spread[spread < 1e-6] = 0, 1
    model = Model(mean, spread, np.zeros(x.shape[1]), np.zeros((2, 2)))
    x = model.scaled(x)
    chains = Chains(n_lines)
    y = np.repeat(label, n_lines)
    held = np.zeros((2, 2))  # transitions of the labels: each chain stays in its own
    held[0, 0] = (n_lines - 1)[label == 0].sum()
    held[1, 1] = (n_lines - 1)[label == 1].sum()
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, move = theta[:-4], theta[-4:].reshape(2, 2)
        p, _, pairs = chains.marginals(x @ w, move)
        grad = np.concatenate([x.T @ (y - p[:, 1]), (held - pairs).ravel()]) / len(label)
        grad -= DECAY * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        rate = RATE * (1 - step / (steps + 1))
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model.weights, model.move = theta[:-4], theta[-4:].reshape(2, 2)
    return model


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
          sample_lines: int = SAMPLE_LINES, chunk_lines: int = CHUNK_LINES) -> Model:
    """A model from ``labels`` (doc_id, quality); pass only rows to learn from."""
    rows = sample(docs, labels, sample_docs, sample_lines, chunk_lines).collect()
    rows.sort(key=lambda r: r.key)  # the same sum in the same order each time
    if not rows:
        return fit(np.zeros((0, WIDTH)), np.zeros(0, dtype=int), np.zeros(0, dtype=int))
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), dtype=np.float32).reshape(-1, WIDTH)
    return fit(x.astype(np.float64), np.array([r.n for r in rows]), np.array([r.y for r in rows]))


def sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
           sample_lines: int = SAMPLE_LINES, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """(key, x, n, y) of the documents that teach: features of n lines, and label.
    One row per doc_id, at most ``sample_lines`` lines in all."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    n = known.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = known.where(share < sample_docs / max(n, 1))  # about sample_docs rows, never with n

    # one text of each doc_id, however many rows share it
    texts = (docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .join(F.broadcast(some), "doc_id").groupBy("doc_id")
             .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))
             .select(F.xxhash64("doc_id", "text").alias("key"), "text", "label"))
    texts = materialise(texts.withColumn("lines", F.least(
        F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(chunk_lines))),
        "quality-sample")
    total, taken = 0, []
    for key, lines in sorted(tuple(r) for r in texts.select("key", "lines").collect()):
        total += lines
        if total > sample_lines:
            break
        taken.append(key)
    last = taken[-1] if taken else None

    def run(batches):
        for b in batches:
            keys, xs, ns, ys = [], [], [], []
            for key, text, y in zip(*(b.column(k).to_pylist() for k in range(3))):
                lines = text.split(b"\n")
                if len(lines) > chunk_lines:
                    at = (key & (1 << 62) - 1) % (len(lines) - chunk_lines + 1)
                    text = b"\n".join(lines[at:at + chunk_lines])
                x, _, n_lines = line_features([text])
                keys.append(key)
                xs.append(x.astype(np.float32).tobytes())
                ns.append(int(n_lines[0]))
                ys.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(xs, pa.binary()), pa.array(ns, pa.int32()),
                 pa.array(ys, pa.int32())], names=["key", "x", "n", "y"])

    chosen = texts.where(F.lit(False) if last is None else F.col("key") <= last)
    return (chosen.select("key", F.col("text").cast("binary").alias("text"), "label")
            .mapInArrow(run, "key long, x binary, n int, y int"))


def score(docs: DataFrame, model: Model, out: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` with the quality score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if keep_text or f.name != "text"]

    def run(batches):
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            got = []
            at = 0
            while at < len(texts):  # some megabytes at a time, whole texts
                size, end = 0, at
                while end < len(texts) and (end == at or size < _PIECE):
                    size += len(texts[end] or b"")
                    end += 1
                got.append(shared.value.scores([t or b"" for t in texts[at:end]]))
                at = end
            scores = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(f.name)) for f in keep] + [pa.array(scores)],
                names=[f.name for f in keep] + [out])

    return text_batches(docs).mapInArrow(run, T.StructType([*keep, T.StructField(out, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` that score 0.5 or more."""
    name = free_name(docs, "_score")
    scored = score(docs, train(docs, labels), name)
    return scored.where(F.col(name) >= 0.5).select(*docs.columns)
