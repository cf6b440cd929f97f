"""An index for metadata containment (M4): hashed (path, value) postings.

Every scalar of a document's metadata is a token: the keys on the way to it (an
array adds none) and its value, hashed to 64 bits. Metadata that contain a filter
hold all of the filter's tokens, so the documents that do are the intersection of
the tokens' postings; the containment test itself then runs on those rows alone.
Postings are sorted into ranges of (token, id): a token that a third of all
documents hold is many rows of several files."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import jsonb

#: Up to so many ids go to the scan as a list; more are joined.
PUSHED_IDS = 1_000


def _scalars(value, path: tuple = ()) -> Iterator[tuple[tuple, str]]:
    """(path, value as text with its type) of every scalar. Nested values wait on a
    stack of their own, so depth has no limit but the parser's."""
    waiting = [(path, value)]
    while waiting:
        at, v = waiting.pop()
        if isinstance(v, dict):
            waiting += [((*at, k), x) for k, x in v.items()]
        elif isinstance(v, list):
            waiting += [(at, x) for x in v]
        elif v is None or isinstance(v, bool):
            yield at, f"b{v}"
        elif isinstance(v, str):
            yield at, "s" + v
        else:  # 1, 1.0 and 10e-1 are one number
            yield at, f"n{Decimal(str(v)).normalize()}"


def tokens(value) -> list[int]:
    """Distinct tokens of a JSON value."""
    out = set()
    for path, v in _scalars(value):
        data = "\x00".join((*path, "\x01" + v)).encode("utf-8", "surrogatepass")
        out.add(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True))
    return sorted(out)


def _parse(text: str):
    try:
        return json.loads(text, parse_float=Decimal, parse_int=Decimal)
    except (ValueError, RecursionError):
        return None


def build(docs: DataFrame, path: str, key: str, metadata: str) -> None:
    """Write (token, key) of all documents; text that is no JSON has no tokens."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            at, out = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                found = tokens(_parse(text)) if text is not None else []
                at += [i] * len(found)
                out += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), b.column(0).take(pa.array(at, pa.int64()))], ["token", key])

    postings = docs.select(key, F.col(metadata).cast("string").alias("m")).mapInArrow(run, f"token long, {key} {kind}")
    (postings.repartitionByRange("token", key).sortWithinPartitions("token", key)
     .write.mode("overwrite").parquet(path))


def candidates(spark: SparkSession, path: str, filter: dict, key: str) -> DataFrame | None:
    """Keys of the documents that hold all tokens of ``filter``, or None if it has
    none (it then says nothing that an index could answer)."""
    wanted = tokens(json.loads(json.dumps(filter), parse_float=Decimal, parse_int=Decimal))
    if not wanted:
        return None
    hits = spark.read.parquet(path).where(F.col("token").isin(wanted))
    if len(wanted) == 1:
        return hits.select(key).distinct()
    return (hits.groupBy(key).agg(F.count_distinct("token").alias("n"))
            .where(F.col("n") == len(wanted)).select(key))


def contains(docs: DataFrame, path: str, filter: dict, key: str, metadata: str,
             pushed: int = PUSHED_IDS) -> DataFrame:
    """Rows of ``docs`` whose metadata contain ``filter``. Few keys reach the scan
    as a list, which skips the row groups without any; more are joined."""
    test = jsonb.json_contains(F.col(metadata), filter)
    found = candidates(docs.sparkSession, path, filter, key)
    if found is None:
        return docs.where(test)
    few = [r[0] for r in found.limit(pushed + 1).collect()]
    if len(few) <= pushed:
        return docs.where(F.col(key).isin(few) & test)
    return docs.join(found, key, "left_semi").where(test)
