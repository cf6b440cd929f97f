"""Run counters and metrics as aggregates over run logs.

Every metric is one aggregation pass with partial (map-side) aggregation;
the histogram is 11 conditional counts in the same pass, unpivoted after.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config


def run_stats(statuses: DataFrame, status_col: str = "status") -> DataFrame:
    """A1: number of inputs per status (processed / error)."""
    return statuses.groupBy(status_col).agg(F.count("*").alias("n"))


def chunks_per_file(files: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """A3: chunks of each processed file; 0 when all its paragraphs were
    filtered out. The chunk counts are aggregated before the join."""
    counts = chunks.groupBy(key).agg(F.count("*").alias("n_chunks"))
    return files.select(key).join(counts, key, "left").select(
        key, F.coalesce(F.col("n_chunks"), F.lit(0)).cast("bigint").alias("n_chunks"))


def execution_counts(log: DataFrame, group_cols: Sequence[str], failed: Column) -> DataFrame:
    """A4: executions (failures included, since the counter goes up before
    the call) and failures."""
    return log.groupBy(*group_cols).agg(F.count("*").alias("executions"),
                                         F.count(F.when(failed, 1)).alias("failures"))


def _label(b: float) -> str:
    return repr(float(b))


def duration_histogram(log: DataFrame, value: Column, group_cols: Sequence[str],
                       observed: Column | None = None,
                       bounds: Sequence[float] = config.LATENCY_BUCKETS) -> DataFrame:
    """A5: cumulative ``<=`` buckets plus +Inf, with the sum and the count of
    the observed values (failed calls are not observed)."""
    x = log if observed is None else log.where(observed)
    aggs = [F.count(F.when(value <= F.lit(float(b)), 1)).alias(f"b{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(value).alias("b_inf"), F.sum(value).alias("sum_value"),
             F.count(value).alias("count_value")]
    wide = x.groupBy(*group_cols).agg(*aggs)
    cells = [F.struct(F.lit(_label(b)).alias("le"), F.col(f"b{i}").alias("n"))
             for i, b in enumerate(bounds)] + [F.struct(F.lit("+Inf").alias("le"), F.col("b_inf").alias("n"))]
    return wide.select(*group_cols, "sum_value", "count_value", F.inline(F.array(*cells)))


def last_value(log: DataFrame, value: Column, ts: Column, group_cols: Sequence[str]) -> DataFrame:
    """The gauge, i.e. the value of the latest entry."""
    return log.groupBy(*group_cols).agg(F.max_by(value, ts).alias("last_value"))


@dataclass
class RunLog:
    """A7 + A8: records ``op, started, seconds, n_rows, ok`` for each wrapped
    call. Rows stay on the driver (one per call, not per data row)."""
    rows: list = field(default_factory=list)

    def record(self, op: str, fn: Callable, *args, **kwargs):
        started = datetime.now(timezone.utc)
        t0 = time.perf_counter()
        ok, n, result = False, None, None
        try:
            result = fn(*args, **kwargs)
            ok = True
            if isinstance(result, list):
                n = len(result)
            return result
        finally:
            self.rows.append((op, started.replace(tzinfo=None), time.perf_counter() - t0, n, ok))

    def wrap(self, op: str):
        def deco(fn):
            def inner(*a, **k):
                return self.record(op, fn, *a, **k)
            return inner
        return deco

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.rows, "op string, started timestamp, seconds double, n_rows long, ok boolean")
