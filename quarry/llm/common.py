"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back: later
    steps reread the files instead of recomputing, also after lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 16 << 20


def _bytes(kind: T.DataType, col: Column) -> Column:
    """About what a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(col) + 8
    if isinstance(kind, T.StructType):
        return sum((_bytes(f.dataType, col[f.name]) for f in kind.fields), F.lit(8))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
            return F.aggregate(col, F.lit(16).cast("long"), lambda acc, x: acc + F.coalesce(
                _bytes(kind.elementType, x), F.lit(8)))
        return 16 + 8 * F.size(col)
    return F.lit(8)


def bounded(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (read from files) marked for broadcast if its rows take at most
    ``most`` bytes; a larger one is left to a shuffled join."""
    width = sum((F.coalesce(_bytes(f.dataType, F.col(f.name)), F.lit(8)) for f in df.schema.fields),
                F.lit(16))
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


BATCH_ROWS = 1_000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, whose whole texts are about to go to Python: the session sends at
    most ``BATCH_ROWS`` rows at a time, unless it has a setting of its own
    (Spark's default of 10,000 suits narrow rows; both sides of the pipe hold
    a whole batch)."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, "10000") == "10000":
        conf.set(_BATCH_KEY, str(BATCH_ROWS))
    return df


def slices(batches, rows: int = 500):
    """Arrow batches of at most ``rows`` rows, without copying: only so many
    texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def in_fold(key: str, modulus: int, fold: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``, equals ``fold``; a null key
    is in no fold."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == F.lit(fold), F.lit(False))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
