"""A Bloom filter as a table, and a ledger guarded by it (F2).

The filter has ``bits`` bits in rows of 64 (slot, word). A key sets ``HASHES`` of
them. Every run appends the rows of its own keys to the filter's folder, next to
the ledger; a slot's word is the union of its rows. A key with a bit missing has
surely never been recorded, so only the few others are looked up in the ledger:
that lookup decides, and a false positive costs a lookup, never a row.

Building and asking are a hash per key and joins on the slot; a filter is far
smaller than the keys it stands for, and only its touched slots exist as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 1 << 33
HASHES = 7
#: Up to so many keys that may be known go to the ledger's scan as a list.
PUSHED_KEYS = 1_000


def _probes(keys: DataFrame, col: str, bits: int) -> DataFrame:
    """(col, slot, mask): the bits of each key."""
    place = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(col)), F.lit(int(bits))) for i in range(HASHES)]))
    at = keys.select(col, place.alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("at"), F.lit(64)).cast("int"))
    return at.select(col, F.shiftright("at", 6).alias("slot"), bit.alias("mask"))


def append(keys: DataFrame, col: str, path: str, bits: int = BITS) -> None:
    """Add the keys of one run to the filter at ``path``."""
    rows = _probes(keys.where(F.col(col).isNotNull()).select(col).distinct(), col, bits)
    (rows.groupBy("slot").agg(F.bit_or("mask").alias("word")).repartitionByRange("slot").sortWithinPartitions("slot")
     .write.mode("append").parquet(path))


def maybe_known(keys: DataFrame, col: str, spark: SparkSession, path: str, bits: int = BITS) -> DataFrame:
    """The distinct keys all of whose bits are set."""
    probes = _probes(keys.where(F.col(col).isNotNull()).select(col).distinct(), col, bits)
    asked = probes.select("slot").distinct()
    words = spark.read.parquet(path).join(asked, "slot", "left_semi").groupBy("slot").agg(F.bit_or("word").alias("word"))
    met = probes.join(words, "slot").where(F.col("word").bitwiseAND(F.col("mask")) != 0)
    # two of a key's hashes may fall on one bit: count what is missing, not what is there
    return (probes.groupBy(col).agg(F.count("*").alias("n")).join(met.groupBy(col).agg(F.count("*").alias("m")), col)
            .where("n = m").select(col))


def new_inputs(batch: DataFrame, ledger: DataFrame, path: str, key: str = "parent", bits: int = BITS,
               pushed: int = PUSHED_KEYS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``batch`` whose key is not in ``ledger``, and the ledger rows that
    were compared: those of keys that the filter could not rule out."""
    k = F.col(key).cast("string")
    suspects = maybe_known(batch.select(k.alias("_k")), "_k", batch.sparkSession, path, bits)
    few = [r[0] for r in suspects.limit(pushed + 1).collect()]
    if len(few) <= pushed:
        read = ledger.where(F.col(key).isin(few))
    else:
        read = ledger.join(suspects, F.col(key) == F.col("_k"), "left_semi")
    known = read.select(F.col(key).cast("string").alias("_done")).distinct()
    return batch.join(known, k == F.col("_done"), "left_anti"), read
