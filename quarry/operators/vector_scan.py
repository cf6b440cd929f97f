"""Distances of a whole vector column through Arrow (Q1, Q2, Q9 at scale).

``mapInArrow`` hands each task's rows over as Arrow record batches; the
``list<float>`` column's flat value buffer is read as a rows x dim matrix
with no per-row conversion, and numpy multiplies it by the query vector (or
the broadcast query matrix). Measured at 1536 dimensions (60,000 rows,
``local[8]``, top-50 by cosine): 0.74 s here against 2.76 s for the native
``aggregate(zip_with)`` expression, which Spark evaluates interpreted, per
element. The same path serves every dimension; ``impl="native"`` asks for
the expression instead, with no Python worker.

A NULL vector, or one whose length is not the table's dimension, gets a
NULL distance, as the native ``zip_with`` form gives it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def choose(impl: str) -> str:
    if impl not in ("arrow", "native"):
        raise ValueError(f"unknown distance implementation {impl!r}")
    return impl


def _column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def vector_matrix(col, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """``(matrix rows x dim in float64, valid mask)`` of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    lens = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    valid = col.is_valid().to_numpy(zero_copy_only=False) & (lens == dim)
    m = np.zeros((n, dim), dtype=np.float64)
    if n and valid.all():
        m[:] = col.flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
    elif valid.any():
        sub = col.filter(pa.array(valid))
        m[valid] = sub.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return m, valid


def distance_block(m: np.ndarray, qmat: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """``(distances queries x rows, zero-norm mask)``; cosine is NaN where a
    norm is zero (the zero mask), the inner metric is ``-a.q``."""
    dots = qmat @ m.T
    if metric == "cosine":
        den = np.linalg.norm(qmat, axis=1)[:, None] * np.linalg.norm(m, axis=1)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 1.0 - dots / den
        zero = den == 0
        return np.where(zero, np.nan, d), zero
    if metric == "inner":
        return -dots, np.zeros(dots.shape, dtype=bool)
    raise ValueError(metric)


def distances(df: DataFrame, query: Sequence[float], metric: str = "cosine", id_col: str = "id",
              vec_col: str = "embedding", out: str = "dist") -> DataFrame:
    """``id, dist`` for every row of ``df`` against one query vector."""
    qmat = np.asarray(query, dtype=np.float64)[None, :]
    dim = qmat.shape[1]

    def run(batches):
        for b in batches:
            m, valid = vector_matrix(_column(b, vec_col), dim)
            d, _ = distance_block(m, qmat, metric)
            yield pa.RecordBatch.from_arrays(
                [_column(b, id_col), pa.array(d[0], type=pa.float64(), mask=~valid)], [id_col, out])

    id_type = dict(df.dtypes)[id_col]
    return df.select(id_col, vec_col).mapInArrow(run, f"{id_col} {id_type}, {out} double")
