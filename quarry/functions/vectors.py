"""Vector column builders (V2-V7). Vectors are ARRAY<FLOAT>; sums run in DOUBLE.

``zip_with`` gives NULL entries when the lengths differ, so callers check the
query length against the table's dimension before building a distance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def _nan() -> Column:
    return F.lit(float("nan"))


def vec_lit(v: Sequence[float]) -> Column:
    """A literal ARRAY<DOUBLE> from a driver-side list (a query vector)."""
    return F.array(*[F.lit(float(x)) for x in v])


def dot(a: Column, b: Column) -> Column:
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def sq_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def norm(a: Column) -> Column:
    return F.sqrt(sq_norm(a))


def l2_normalize(a: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double") * 0.0)) \
        .otherwise(F.transform(a, lambda x: x.cast("double") / n))


def cosine_distance(a: Column, q: Sequence[float] | Column) -> Column:
    """V5: ``1 - a.q / (|a| |q|)``; NaN when either norm is 0 (no division)."""
    if isinstance(q, Column):
        qn = norm(q)
        qv = q
    else:
        qn = F.lit(float(sum(float(x) * float(x) for x in q)) ** 0.5)
        qv = vec_lit(q)
    an = norm(a)
    denom = an * qn
    return F.when(denom == 0, _nan()).otherwise(F.lit(1.0) - dot(a, qv) / denom)


def neg_inner_product(a: Column, q: Sequence[float] | Column) -> Column:
    """V6: ``-(a.q)``."""
    qv = q if isinstance(q, Column) else vec_lit(q)
    return -dot(a, qv)


def fit_dim(v: Column, dim: int) -> Column:
    """V2: pad with 0.0 or cut to ``dim``."""
    return F.slice(F.concat(v.cast("array<float>"),
                            F.array_repeat(F.lit(0.0).cast("float"), dim)), 1, dim)


def zero_fallback(v: Column, dim: int) -> Column:
    """V3: a missing (failed) vector becomes ``[0.0] * dim``."""
    return F.coalesce(v.cast("array<float>"), F.array_repeat(F.lit(0.0).cast("float"), dim))


def vector_dims(v: Column) -> Column:
    """V4."""
    return F.size(v)


def encode_e6(v: Column) -> Column:
    """A vector as comma-joined integers of value * 1e6 (stable to compare)."""
    return F.array_join(F.transform(v, lambda x: F.round(x.cast("double") * 1e6).cast("bigint")), ",")
