"""Best-fit-decreasing packing of token sequences.

A document is its token ids and one closing id. Documents over the sequence
length are cut into pieces of that length. Full pieces are sequences of their
own; all others are dealt evenly into groups of about ``group_pieces`` and each
group is packed by one task: longest piece first, into the open sequence with
the least room that still holds it. The open sequences are the leaves of a
segment tree over the remaining room (0 to the sequence length), so the
tightest fit is found in as many steps as the tree has levels. The number of
groups follows the number of pieces; a group wastes at most about one
half-empty sequence in some thousands.

Tokens are made once and written as lengths and checksums; ids travel only if
``with_ids`` asks for them.

Defined cases: a null text counts as empty and is the closing id alone;
repeated documents are packed one by one; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise, slices, text_batches, text_or_empty

SEQUENCE = 4096
CLOSING_ID = 1
GROUP_PIECES = 10_000
VOCABULARY = "word_bpe_49k.json"
_CACHE_WORDS = 400_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _by_words(path: str) -> bool:
    """Whether the tokenizer normalises and splits as ``VOCABULARY`` does, with
    added tokens that no blank, comma or full stop is part of or acts on."""
    if path == vocabulary_path():
        return True

    def head(name):
        with open(name, encoding="utf-8") as f:
            t = json.load(f)
        model = {k: v for k, v in t["model"].items() if k not in ("vocab", "merges")}
        return (t["normalizer"], t["pre_tokenizer"], model), t.get("added_tokens") or []

    ours, added = head(path)
    return ours == head(vocabulary_path())[0] and not any(
        t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]
        or any(c in ".," or c.isspace() for c in t["content"]) for t in added)


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    The tokenizer never joins anything across a blank or a line end, so each
    blank-separated part is encoded once and remembered by the worker process.
    A final comma or full stop after a letter is always a token of its own and
    case never matters but in an added token, so only the bare lower-case part is
    encoded. The memory is bounded: of two halves the older one is dropped when
    the newer is full. A tokenizer of another form encodes whole texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = _by_words(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ask(self, parts: list[str]) -> None:
        for p, e in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
            self.known[p] = array("I", e.ids).tobytes()

    def _learn(self, parts: list[str]) -> None:
        new = [p for p in dict.fromkeys(parts) if p not in self.known]
        if len(self.known) + 2 * len(new) > _CACHE_WORDS:
            self.known, self.older = {}, self.known
            new = list(dict.fromkeys(parts))
        known, older, split, ask = self.known, self.older, [], {}
        for p in new:
            if p in older:
                known[p] = older[p]
                continue
            mark = p[-1:] if p[-1:] in (".", ",") and p[-2:-1].lower().isalpha() else ""
            bare = p[:-1] if mark else p
            # up to U+00FF lower case is one character for one and nothing composes
            low = bare.lower() if bare and max(bare) < "\u0100" else bare
            # added tokens are found in the text as it is
            bare = bare if any(t in bare or t in low for t in self.added) else low
            split.append((p, bare, mark))
            if bare in older:
                known[bare] = older[bare]
            elif bare not in known:
                ask[bare] = None
        self._ask([*ask, *(m for m in (".", ",") if m not in known)])
        for p, bare, mark in split:
            known[p] = known[bare] + known[mark] if mark else known[bare]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(
                texts, add_special_tokens=False)]
        out = []
        for text in texts:
            parts = text.replace("\n", " ").split(" ")
            try:
                out.append(b"".join(map(self.known.__getitem__, parts)))
            except KeyError:
                self._learn(parts)
                out.append(b"".join(map(self.known.__getitem__, parts)))
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process: later tasks find the words of earlier ones."""
    return Encoder(path)


def pieces(docs: DataFrame, path: str | None = None, length: int = SEQUENCE,
           with_ids: bool = False, closing_id: int = CLOSING_ID) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32
    and, if asked for, ids (little-endian unsigned 32-bit)."""
    path = path or vocabulary_path()
    end = np.asarray([closing_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in slices(batches):
            yield cut_slice(b)

    def cut_slice(b):
        rows, piece, start, size, crc, ids = [], [], [], [], [], []
        for k, data in enumerate(encoder(path).encode(b.column(1).to_pylist())):
            data += end
            for p, at in enumerate(range(0, len(data), 4 * length)):
                part = data[at:at + 4 * length]
                rows.append(k)
                piece.append(p)
                start.append(at // 4)
                size.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                ids.append(part if with_ids else b"")
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(size, pa.int64()),
             pa.array(crc, pa.int64())] + [pa.array(ids, pa.binary())] * with_ids, names=names)

    return text_batches(docs).select("doc_id", text_or_empty().alias("text")).mapInArrow(
        cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
             + ", ids binary" * with_ids)


class RoomTree:
    """Open bins by remaining room: a segment tree whose leaf r holds the bins
    with r places left and whose nodes count the bins below them."""

    def __init__(self, size: int):
        self.base = 1
        while self.base < size + 1:
            self.base *= 2
        self.count = [0] * (2 * self.base)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.base
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, bin_id: int) -> None:
        self.bins[room].append(bin_id)
        self._add(room, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (bin, room) of least room at or over ``need``."""
        count, node = self.count, need + self.base
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1  # up until a filled right neighbour
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.base
        bin_id = self.bins[room].pop()
        self._add(room, -1)
        return bin_id, room


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length (longest first), best fit."""
    tree, bins, offsets, opened = RoomTree(size), [], [], 0
    for n in lengths:
        found = tree.take_tightest(n)
        if found is None:
            found = (opened, size)
            opened += 1
        bin_id, room = found
        bins.append(bin_id)
        offsets.append(size - room)
        if room > n:
            tree.put(room - n, bin_id)
    return bins, offsets


def pack(cut: DataFrame, length: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces (see ``pieces``) with sequence_id and offset. ``cut`` should
    be read from files: it is counted first."""
    n = cut.where(F.col("length") < length).count()
    groups = max(1, round(n / group_pieces))
    row = F.monotonically_increasing_id()
    # full pieces: a sequence each, numbered from -1 down
    whole = (cut.where(F.col("length") >= length)
             .select("*", (F.lit(-1).cast("long") - row).alias("sequence_id"),
                     F.lit(0).cast("long").alias("offset")))
    small = cut.where(F.col("length") < length)
    # dealt by the row, not by doc_id: repeated ids spread over all groups
    dealt = small.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", row),
                                              F.lit(groups)).cast("long"))
    out = whole.schema

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(table.column("length").to_pylist(), length)
        group = table.column("_group")[0].as_py()
        # at most as many sequences as pieces: ids of groups never meet
        ids = np.asarray(bins, dtype=np.int64) * groups + group
        return (table.drop_columns(["_group"])
                .append_column("sequence_id", pa.array(ids))
                .append_column("offset", pa.array(offsets, pa.int64())))

    packed = dealt.groupBy("_group").applyInArrow(fill, out)
    return whole.unionByName(packed)


def pack_documents(docs: DataFrame, path: str | None = None, length: int = SEQUENCE,
                   group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece."""
    return pack(materialise(pieces(docs, path, length, with_ids), "pieces"), length, group_pieces)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves (needs ids): sequence_id, ids, doc_ids."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    joined = F.aggregate(F.col("p"), F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return (packed.groupBy("sequence_id").agg(part.alias("p"))
            .select("sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids")))
