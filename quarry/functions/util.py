"""Small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(bindings: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """Evaluate each bound expression once and pass them to ``body`` as the
    fields of one lambda variable. Catalyst neither inlines a lambda argument
    into the lambda body nor re-evaluates it, so arrays used inside nested
    higher-order functions are computed once per row, not once per element."""
    s = F.struct(*[c.alias(k) for k, c in bindings.items()])
    return F.transform(F.array(s), body)[0]


def scan(items: Column, init: Column, step: Callable[[Column, Column], tuple[Column, Column]],
         out_type: str) -> Column:
    """What ``step(state, item)`` puts out for every item, in order; it returns
    the next state (a struct like ``init``) and the output. The fold runs in
    blocks of about the square root of the length, so that appending copies
    one block's outputs, not all of them."""
    def fold(state, block):
        def add(acc, x):
            state, out = step(acc["st"], x)
            return F.struct(state.alias("st"), F.concat(acc["out"], F.array(out)).alias("out"))
        return F.aggregate(block, F.struct(state.alias("st"), F.array().cast(
            f"array<{out_type}>").alias("out")), add)

    def blocks(s):
        n = F.size(s["items"])
        width = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
        parts = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), width),
                            lambda at: F.slice(s["items"], at + 1, width))
        start = F.struct(init.alias("st"), F.array().cast(f"array<array<{out_type}>>").alias("out"))
        return F.flatten(F.aggregate(parts, start, lambda acc, b: let(
            {"i": fold(acc["st"], b)}, lambda z: F.struct(
                z["i"]["st"].alias("st"), F.concat(acc["out"], F.array(z["i"]["out"])).alias("out"))))["out"])
    return let({"items": items}, blocks)


def slices(batches, rows: int = 500):
    """Arrow batches of at most ``rows`` rows, without copying: only so many rows
    are Python objects at a time, however many a batch holds."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def spread(df: DataFrame, factor: int = 1) -> DataFrame:
    """Round-robin repartition when a CPU-heavy per-row stage would otherwise
    run on fewer tasks than the cluster has cores (one small file gives one
    task). Large inputs already have enough splits and are left alone."""
    par = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df
