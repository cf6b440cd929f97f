"""Row numbering that survives hot groups (S11 ids, S15 archive names, Q13).

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row of a
group to one task; a group holding a third of all rows would then run in one
task. Here the rows are range-partitioned on ``(g, o)`` (sampled bounds split
a hot group over many tasks), numbered inside each sorted partition, and the
counts of the groups that continue from one partition into the next are
carried forward. Only one row per partition reaches the driver. The numbered
rows are checkpointed once, so offsets and rows always agree. Without groups the
place in a sorted partition is the low part of Spark's own row id, and nothing
leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import cut_lineage


def _key_tuple(row, cols):
    return tuple(row[c] for c in cols)


def number_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                  out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 1, 2, ... within each group of ``group_cols`` in the order
    of ``order_cols`` (ascending; negate a column for descending). Ties in the
    order are broken arbitrarily, as with ``row_number``."""
    spark = df.sparkSession
    group_cols = list(group_cols)
    n = num_partitions or max(spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions")))
    okeys = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    onames = [f"_o{i}" for i in range(len(okeys))]
    base = df.select("*", *[k.alias(nm) for k, nm in zip(okeys, onames)])
    keys = group_cols + onames
    ranged = base.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    if not group_cols:
        return _number_all(ranged, out).drop(*onames)
    schema = T.StructType(ranged.schema.fields + [T.StructField("_pid", T.IntegerType()),
                                                  T.StructField("_lrn", T.LongType())])

    def local(batches):
        import numpy as np
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        prev_key, prev_n = None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            change = np.zeros(len(pdf), dtype=bool)
            for c in group_cols:
                v = pdf[c]
                same = v.eq(v.shift()) | (v.isna() & v.shift().isna())
                change |= ~same.to_numpy()
            first = tuple(pdf[c].iloc[0] for c in group_cols)
            change[0] = prev_key is None or first != prev_key
            run = pd.Series(np.cumsum(change), index=pdf.index)
            lrn = run.groupby(run).cumcount().to_numpy() + 1
            if not change[0]:
                lrn[run.to_numpy() == run.iloc[0]] += prev_n
            prev_key = tuple(pdf[c].iloc[-1] for c in group_cols)
            prev_n = int(lrn[-1])
            yield pdf.assign(_pid=pid, _lrn=lrn.astype("int64"))

    # Materialised once (reliable checkpoint in the shared folder): the range
    # bounds come from sampling, and a recomputation after a shuffle could
    # sample other bounds, so both the offsets and the rows must come from
    # the same copy. This also cuts the lineage against executor loss.
    numbered = cut_lineage(ranged.mapInPandas(local, schema))
    # First and last group of every partition (one row per partition).
    firsts = numbered.where(F.col("_lrn") >= 1).groupBy("_pid").agg(
        F.min(F.struct(*keys)).alias("first"), F.max(F.struct(*keys, "_lrn")).alias("last"))
    bounds = sorted(firsts.collect(), key=lambda r: r["_pid"])
    carry_key, carry_n = None, 0
    offsets = []
    for b in bounds:
        fk = _key_tuple(b["first"], group_cols)
        lk = _key_tuple(b["last"], group_cols)
        if carry_key is not None and fk == carry_key:
            offsets.append((b["_pid"], *fk, carry_n))
            if lk == fk:
                carry_n += b["last"]["_lrn"]
                continue
        carry_key, carry_n = lk, b["last"]["_lrn"]
    if not offsets:
        result = numbered.withColumn(out, F.col("_lrn"))
    else:
        ofs_schema = T.StructType([T.StructField("_pid", T.IntegerType())]
                                  + [df.schema[c] for c in group_cols]
                                  + [T.StructField("_ofs", T.LongType())])
        ofs = spark.createDataFrame(offsets, ofs_schema)
        cond = [numbered["_pid"] == ofs["_pid"]] + [numbered[c].eqNullSafe(ofs[c]) for c in group_cols]
        j = numbered.join(F.broadcast(ofs), cond, "left")
        result = j.select(numbered["*"], (numbered["_lrn"] + F.coalesce(ofs["_ofs"], F.lit(0)))
                          .alias(out))
    return result.drop("_pid", "_lrn", *onames)


_PLACE_BITS = 33  # FIXED: the low bits of monotonically_increasing_id count a partition's rows


def _number_all(ranged: DataFrame, out: str) -> DataFrame:
    """Number rows that are sorted within ranges: the rows of the partitions before,
    and the place in the own one."""
    numbered = cut_lineage(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright("_mid", _PLACE_BITS)
    counts = numbered.groupBy(pid.alias("_pid")).count().collect()
    before, offsets = 0, []
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], before))
        before += r["count"]
    spark = ranged.sparkSession
    ofs = spark.createDataFrame(offsets, "_pid long, _ofs long")
    place = F.col("_mid").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (numbered.withColumn("_pid", pid).join(F.broadcast(ofs), "_pid")
            .withColumn(out, place + F.col("_ofs") + 1).drop("_pid", "_ofs", "_mid"))
