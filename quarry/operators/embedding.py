"""Embedding (V1, V3, V8, V9).

An embedder is a function ``Column(text) -> Column(ARRAY<FLOAT>)``. The
built-in one hashes words into ``dim`` buckets (the bucket of a word is the
first 32 bits of its MD5, modulo ``dim``) and L2-normalises the counts: the
word split is native; the distinct words of an Arrow batch are hashed once each
and the buckets counted by one ``np.bincount``. A model plug-in is an iterator
pandas UDF that loads the model once per Python worker and encodes whole
Arrow batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import fulltext as ft
from quarry.functions import vectors as vec

Embedder = Callable[[Column], Column]
BATCH_TEXTS = 1_000   # texts whose words are numbers in memory at a time


def _buckets(words: pa.Array, dim: int) -> np.ndarray:
    """Bucket of every word: ``int(md5(word)[:8], 16) % dim``, computed once for
    each distinct one."""
    held = words.dictionary_encode()
    of = np.array([int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") % dim
                   for w in held.dictionary.to_pylist()], dtype=np.int64)
    return of[held.indices.to_numpy(zero_copy_only=False)]


def _bincount_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def counts(words: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(words), BATCH_TEXTS):
            part = words.slice(at, BATCH_TEXTS)
            n = pc.list_value_length(part).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n), dtype=np.int64), n)
            c = np.bincount(row * dim + _buckets(part.flatten(), dim), minlength=len(n) * dim).reshape(len(n), dim)
            norm = np.sqrt((c * c).sum(axis=1, keepdims=True).astype(np.float64))
            parts.append((c / np.where(norm > 0, norm, 1)).astype(np.float32).ravel())
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)
        starts = np.arange(len(words) + 1, dtype=np.int32) * dim
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.float32()))
    return counts


def hash_embedder(dim: int) -> Embedder:
    """V1 default: hashed bag of words, unit length (zero for no words)."""
    udf = _bincount_udf(int(dim))
    return lambda text: udf(ft.words(text))


def model_embedder(load: Callable[[], Callable[[list[str]], np.ndarray]], dim: int) -> Embedder:
    """V1 plug-in: ``load()`` returns ``encode(list[str]) -> ndarray[n, d]``;
    it runs once per Python worker. A batch that fails is encoded text by text;
    only a text that fails by itself yields NULL, which ``zero_fallback`` turns
    into a zero vector flagged as failed (V3)."""
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()

        def one(text):
            try:
                return np.asarray(model([text]), dtype=np.float32)[0]
            except Exception:  # noqa: BLE001 - a text that cannot be encoded
                return None

        for texts in batches:
            texts = texts.fillna("").tolist()
            try:
                yield pd.Series(list(np.asarray(model(texts), dtype=np.float32)))
            except Exception:  # noqa: BLE001 - some text of the batch fails: find which
                yield pd.Series([one(t) for t in texts])
    return lambda text: vec.fit_dim(encode(text), dim)


def embed(df: DataFrame, text_col: str, dim: int, embedder: Embedder | None = None,
          out: str = "embedding") -> DataFrame:
    """V1 + V2 + V3: vector fitted to ``dim``; a failure (NULL) becomes a zero
    vector and sets ``embed_failed``."""
    e = (embedder or hash_embedder(dim))(F.col(text_col))
    x = df.withColumn("_e", e)
    return (x.withColumn("embed_failed", F.col("_e").isNull())
             .withColumn(out, vec.zero_fallback(vec.fit_dim(F.col("_e"), dim), dim))
             .drop("_e"))


def embed_lists(df: DataFrame, key: str, list_col: str, dim: int, embedder: Embedder | None = None,
                out: str = "embeddings") -> DataFrame:
    """V8: ``key`` and one vector per text of an ``ARRAY<STRING>``, in its order.
    Texts are embedded one to a row, so a long list is spread over batches; an
    empty list gives an empty array, a NULL one NULL. ``key`` is unique."""
    items = df.select(key, F.posexplode(list_col).alias("_pos", "_text"))
    rows = embed(items, "_text", dim, embedder, out="_v").groupBy(F.col(key).alias("_key")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_v"))), lambda x: x["_v"]).alias("_vs"))
    joined = df.select(key, F.col(list_col).isNull().alias("_null")).join(
        rows, F.col(key) == F.col("_key"), "left")
    empty = F.array().cast("array<array<float>>")
    return joined.select(key, F.when(~F.col("_null"), F.coalesce("_vs", empty)).alias(out))


# FIXED: menu keys, embedding models and their output dimensions.
MODEL_REGISTRY = (
    ("1", "mixedbread-ai/mxbai-embed-large-v1", 1024),
    ("2", "PORTULAN/serafim-900m-portuguese-pt-sentence-encoder-ir", 1536),
    ("3", "sentence-transformers/all-MiniLM-L6-v2", 384),
    ("4", "sentence-transformers/paraphrase-multilingual-MiniLM-L12-v2", 384),
    ("5", "sentence-transformers/all-mpnet-base-v2", 768),
)


def registry_frame(spark, registry=MODEL_REGISTRY) -> DataFrame:
    return spark.createDataFrame(list(registry), "key string, model string, dim int")


MAX_REGISTRY_ROWS = 100_000


def resolve_models(requests: DataFrame, registry: DataFrame, default_model: str,
                   model_col: str = "model") -> DataFrame:
    """V9: absent model -> default; known model -> its dimension, status
    'ok'; unknown -> status 'rejected'. The registry is a configuration table
    of a handful of rows: broadcast once its size is checked."""
    req = requests.withColumn(model_col, F.coalesce(F.col(model_col), F.lit(default_model)))
    reg = registry.select(F.col("model").alias("_m"), "dim")
    if reg.count() <= MAX_REGISTRY_ROWS:
        reg = F.broadcast(reg)
    j = req.join(reg, req[model_col] == reg["_m"], "left")
    return j.withColumn("status", F.when(F.col("_m").isNull(), F.lit("rejected"))
                        .otherwise(F.lit("ok"))).drop("_m")
