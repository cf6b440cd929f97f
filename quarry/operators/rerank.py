"""Reranking of a file's chunks against its query (Q13, Q14)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import fulltext as ft
from quarry.operators.numbering import number_within

Scorer = Callable[[Column, Column], Column]


def overlap_score(query: Column, content: Column) -> Column:
    """Built-in scorer: share of the query's distinct words found in the
    content (0 for a query without words)."""
    qw = F.array_distinct(ft.words(query))
    hit = F.size(F.array_intersect(qw, ft.words(content)))
    return F.when(F.size(qw) == 0, F.lit(0.0)).otherwise(hit / F.size(qw))


def model_scorer(load: Callable[[], Callable[[list, list], np.ndarray]]) -> Scorer:
    """Plug-in scorer (a cross-encoder): ``load()`` once per Python worker
    returns ``predict(queries, contents) -> scores``; Arrow batches of pairs."""
    @F.pandas_udf(T.DoubleType())
    def score(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for qs, cs in it:
            yield pd.Series(np.asarray(model(qs.tolist(), cs.tolist()), dtype=np.float64))
    return lambda q, c: score(q, c)


def rerank(chunks: DataFrame, group: str, query: Column, content: Column,
           scorer: Scorer = overlap_score, order_col: str = "chunk_index") -> DataFrame:
    """Q13: ``rerank_score`` and ``rerank_pos`` (1 = best) within each group,
    only where the query is non-empty; ties keep chunk order (a stable sort).
    The numbering does not gather a whole group in one task."""
    x = chunks.where(F.coalesce(F.length(query) > 0, F.lit(False))) \
              .withColumn("rerank_score", scorer(query, content).cast("double"))
    return number_within(x, [group], [-F.col("rerank_score"), F.col(order_col)], out="rerank_pos")


def top_scores(chunks: DataFrame, group: str, n: int = 3, order_col: str = "chunk_index") -> DataFrame:
    """Q14: the best ``n`` scores of each group with 4 decimals. ``row_number
    <= n`` is planned with a partial per-task limit before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.col("rerank_score").desc(), F.col(order_col))
    r = chunks.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return r.select(group, F.col("_r").alias("pos"),
                    F.format_number("rerank_score", 4).alias("score_4"))
