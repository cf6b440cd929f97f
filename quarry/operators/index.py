"""Inverted index of the text vectors (L11), re-aimed from a GIN index.

Postings stay one row per (lexeme, document) with the positions of that
lexeme in that document: a frequent lexeme is many rows, never one giant
row. The table is range-partitioned and sorted by lexeme, so a hot lexeme
is split over files and a lookup reads only the row groups whose lexeme
range covers it (Parquet min/max pruning).
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions.util import let, slices


def postings(docs: DataFrame, key: str, text_col: str, dictionary: str = "simple") -> DataFrame:
    """``lexeme, key, n, positions`` with all positions, from 1. ``key`` is the
    table's key: a document's occurrences are gathered within its own row, and
    nothing is shuffled before the index is written."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in slices(batches):
            at, words, where = [], [], []
            for i, ws in enumerate(b.column(1).to_pylist()):
                held: dict[str, list[int]] = {}
                for pos, w in enumerate(ws, 1):
                    held.setdefault(w, []).append(pos)
                at += [i] * len(held)
                words += held
                where += held.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), b.column(0).take(pa.array(at, pa.int64())),
                 pa.array(map(len, where), pa.int64()), pa.array(where, pa.list_(pa.int32()))],
                ["lexeme", key, "n", "positions"])

    return docs.select(key, ft.words(F.col(text_col), dictionary).alias("ws")).mapInArrow(
        run, f"lexeme string, {key} {kind}, n long, positions array<int>")


def write_index(post: DataFrame, path: str, key: str, num_partitions: int | None = None) -> None:
    """Sorted by lexeme; the number of files follows the session's shuffle
    partitions and, at run time, the size of the data."""
    ranged = post.repartitionByRange(num_partitions, "lexeme", key) if num_partitions else \
        post.repartitionByRange("lexeme", key)
    (ranged.sortWithinPartitions("lexeme", key)
         .write.mode("overwrite").parquet(path))


def lookup(spark: SparkSession, path: str, lexemes: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("lexeme").isin(list(lexemes)))


def doc_freq(docs: DataFrame, key: str, text_col: str, dictionary: str = "simple") -> DataFrame:
    """Documents and occurrences per lexeme. ``key`` is the table's key, so a
    document's distinct words are found inside its row; one shuffle of partial
    sums per lexeme follows."""
    ws = let({"w": ft.words(F.col(text_col), dictionary)}, lambda s: F.concat(
        F.transform(s.w, lambda w: F.struct(w.alias("lexeme"), F.lit(0).alias("doc"), F.lit(1).alias("occ"))),
        F.transform(F.array_distinct(s.w), lambda w: F.struct(
            w.alias("lexeme"), F.lit(1).alias("doc"), F.lit(0).alias("occ")))))
    return docs.select(F.inline(ws)).groupBy("lexeme").agg(
        F.sum("doc").alias("n_docs"), F.sum("occ").alias("n_occ"))
