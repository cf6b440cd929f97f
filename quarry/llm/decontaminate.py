"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are the maximal runs of ASCII letters and digits and of all characters
from U+0080 up, after A-Z is lower-cased. A window is ``n`` consecutive words
of one benchmark item; an item of fewer words, but not none, is one window.
The distinct windows are broadcast (hash set plus the words they are made of).
A task maps a document's words to vocabulary numbers, looks only at stretches
made of benchmark words alone, tests the rolling hashes of those windows
against the set, and verifies each hit on the words themselves.

The broadcast has a bound: the windows' size is measured first, and a larger
set is taken in blocks of at most ``max_broadcast_bytes``, one scan of the
documents each, whose hits are merged. Results do not depend on the bound.

Defined cases: a null or empty text has no words and is never hit; a null
benchmark text has no windows; a null item_id is named ``null``; items that
share an id count once; repeated documents are judged one by one; an empty
table on either side gives no hits. Other columns pass through unread.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import free_name, materialise, slices, text_batches

WINDOW = 10
MAX_BROADCAST_BYTES = 64 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _word_table() -> bytes:
    out = bytearray(b" " * 256)
    for b in range(256):
        c = bytes([b]).lower()
        if c.isalnum() or b >= 0x80:
            out[b] = c[0]
    return bytes(out)


_WORDS = _word_table()


def words_of(data: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text."""
    return data.translate(_WORDS).split()


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The distinct (item, length, window) of the benchmark's texts; a window
    is its words joined by blanks."""
    def cut(batches):
        for b in batches:
            items, lengths, wins = [], [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(text or b"")
                k = min(n, len(w))
                for i in range(len(w) - k + 1 if k else 0):
                    items.append(item)
                    lengths.append(k)
                    wins.append(b" ".join(w[i:i + k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(lengths, pa.int32()),
                 pa.array(wins, pa.binary())], names=["item", "length", "win"])

    src = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(cut, "item string, length int, win binary").distinct()


class NgramSet:
    """Windows by length: vocabulary, sorted hashes, and the exact windows with
    the items that hold them."""

    def __init__(self, rows):
        self.vocab: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, list[str]]] = {}
        for item, length, win in rows:
            win = bytes(win)
            for w in win.split(b" "):
                self.vocab.setdefault(w, len(self.vocab))
            self.items.setdefault(length, {}).setdefault(win, []).append(item)
        self.hashes = {}
        for length, wins in self.items.items():
            ids = np.array([[self.vocab[w] for w in win.split(b" ")] for win in wins],
                           dtype=np.uint64)
            self.hashes[length] = np.unique(self._hash(ids.T))

    @staticmethod
    def _hash(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = (h ^ (c + np.uint64(1))) * _MIX
            h ^= h >> np.uint64(29)
        return h

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word runs [start, end) inside occurring windows, and their items."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        n = len(words)
        if not n or not self.vocab:
            return found, items
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, n)
        foreign = np.concatenate(([0], np.cumsum(ids < 0)))
        for length, hashes in self.hashes.items():
            if length > n:
                continue
            at = np.flatnonzero(foreign[length:] == foreign[:n - length + 1])
            if not len(at):
                continue
            h = self._hash([ids[at + k].astype(np.uint64) for k in range(length)])
            slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            exact = self.items[length]
            for i in at[hashes[slot] == h].tolist():
                held = exact.get(b" ".join(words[i:i + length]))
                if held is not None:
                    found.append((i, i + length))
                    items.update(held)
        return merge_runs(found), items


def merge_runs(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_words(data: bytes, runs: list[tuple[int, int]]) -> str:
    """The text without the words of ``runs`` and what stands between them."""
    mapped, pos, k, spans = data.translate(_WORDS), 0, 0, []
    for start, end in runs:  # byte place of each run's first and last word
        a = b = 0
        while k < end:
            while mapped[pos] == 32:
                pos += 1
            a = pos if k == start else a
            pos = mapped.find(b" ", pos)
            pos = len(mapped) if pos < 0 else pos
            b, k = pos, k + 1
        spans.append((a, b))
    out, last = [], 0
    for a, b in spans:
        out.append(data[last:a])
        last = b
    return b"".join([*out, data[last:]]).decode("utf-8", "replace")


def _blocks(wins: DataFrame, bound: int):
    """One NgramSet per block of windows, each at most about ``bound`` bytes."""
    row = wins.agg(F.sum(F.octet_length("win") + F.octet_length("item") + 16)).first()
    n = max(1, -(-int(row[0] or 0) // bound))
    for k in range(n):
        part = wins if n == 1 else wins.where(F.pmod(F.xxhash64("win"), F.lit(n)) == k)
        yield NgramSet((r.item, r.length, r.win) for r in part.toLocalIterator()), k == n - 1


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, keep_text: bool = True,
         max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with three more columns, and their names: ``n_words``, ``runs``
    (flat start, end pairs of hit words, end exclusive) and ``items`` (sorted).
    The text column is left out unless ``keep_text``."""
    spark = docs.sparkSession
    name = {k: free_name(docs, f"_{k}") for k in ("n_words", "runs", "items")}
    out = docs.select("*", F.lit(0).cast("long").alias(name["n_words"]),
                      F.array().cast("array<int>").alias(name["runs"]),
                      F.array().cast("array<string>").alias(name["items"]))
    full = out.schema
    wins = materialise(windows(benchmark, n), "windows")
    first = True
    for grams, last in _blocks(wins, max_broadcast_bytes):
        out = out if first else materialise(out, "hits")
        schema = T.StructType([f for f in full.fields
                               if keep_text or not last or f.name != "text"])
        out = text_batches(out).mapInArrow(_scanner(spark.sparkContext.broadcast(grams), name, schema.names),
                             schema)
        first = False
    return out, name


def _scanner(shared, name, columns):
    def run(batches):
        grams = shared.value
        for b in slices(batches):
            n_words, all_runs, all_items = [], [], []
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            had = zip(b.column(b.schema.get_field_index(name["runs"])).to_pylist(),
                      b.column(b.schema.get_field_index(name["items"])).to_pylist())
            for text, (runs0, items0) in zip(texts, had):
                words = words_of(text or b"")
                runs, items = grams.find(words)
                if runs0:
                    runs = merge_runs([*runs, *zip(runs0[::2], runs0[1::2])])
                n_words.append(len(words))
                all_runs.append([x for r in runs for x in r])
                all_items.append(sorted(items.union(items0)))
            new = {name["n_words"]: pa.array(n_words, pa.int64()),
                   name["runs"]: pa.array(all_runs, pa.list_(pa.int32())),
                   name["items"]: pa.array(all_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [new[c] if c in new else b.column(b.schema.get_field_index(c)) for c in columns],
                names=columns)
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, runs of hit words, items."""
    found, name = scan(docs.select("doc_id", "text"), benchmark, n, False, max_broadcast_bytes)
    runs = F.col(name["runs"])
    signed = F.transform(runs, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long"))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return found.select("doc_id", F.col(name["n_words"]).alias("n_words"), n_hit.alias("n_hit"),
                        runs.alias("runs"), F.col(name["items"]).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                  remove: str = "documents",
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` without its contaminated documents, or (``remove="spans"``) with
    the hit passages cut out of their texts. Columns stay as they are."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove: documents or spans")
    found, name = scan(docs, benchmark, n, True, max_broadcast_bytes)
    if remove == "documents":
        return found.where(F.size(name["runs"]) == 0).select(*docs.columns)
    columns, hit = docs.columns, name["runs"]

    def cut(batches):
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            runs = b.column(b.schema.get_field_index(hit)).to_pylist()
            new = [t if not r else cut_words(t, list(zip(r[::2], r[1::2]))).encode()
                   for t, r in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.binary()).cast(pa.string()) if c == "text"
                 else b.column(b.schema.get_field_index(c)) for c in columns],
                names=columns)

    return found.mapInArrow(cut, docs.schema)
