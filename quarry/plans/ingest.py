"""Ingest job (F2-F5) and the chunk table.

One lazy plan per run: gate -> paragraphs -> chunks -> metadata -> vector ->
text vector -> ids -> partitioned append. Errors are rows with a status,
never exceptions. The only shuffle of size is the id numbering (a range
partition, safe with hot parents); everything else is per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import jsonb
from quarry.operators import chunking as ch
from quarry.operators import embedding as emb
from quarry.operators import expansion
from quarry.operators.numbering import number_within
from quarry.session import cut_lineage
from quarry.sources import html

# One schema for every dimension; the dimension is the partition column.
CHUNK_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("parent", T.StringType(), False),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("metadata", T.StringType(), False),
    # the metadata parsed once at ingest: filters read it without parsing
    T.StructField("meta_v", T.VariantType(), True),
    # the indexed keys as real columns: equalities on them reach the scan
    T.StructField("meta_hot", T.StructType([T.StructField(k, T.StringType())
                                            for k in config.HOT_META_KEYS]), True),
    T.StructField("embedding", T.ArrayType(T.FloatType()), False),
    T.StructField("tsv", T.ArrayType(T.StructType([
        T.StructField("lexeme", T.StringType()), T.StructField("pos", T.IntegerType()),
        T.StructField("weight", T.StringType())])), True),
    T.StructField("created_at", T.TimestampType(), True),
    # the text could not be embedded: a zero vector stands for it
    T.StructField("embed_failed", T.BooleanType(), True),
    T.StructField("dim", T.IntegerType(), False),
])
# One row per input and run; ``run_max_id`` is the largest id the run assigned.
STATUS_SCHEMA = "parent string, status string, n_chunks long, n_failed long, run_max_id long"


@dataclass
class IngestResult:
    chunks: DataFrame
    statuses: DataFrame


def _read(spark: SparkSession, path: str | None, schema: T.StructType | None = None) -> DataFrame | None:
    """A table, or None if nothing was written yet. The small status table
    merges the schemas of its files; the chunk table has a fixed one."""
    if not path:
        return None
    if not _has_files(spark, path):
        return None
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def _has_files(spark: SparkSession, path: str) -> bool:
    """Something was written below ``path``. Only a missing or empty folder
    says no; any other trouble (permission, network, a damaged file) raises."""
    try:
        spark.read.option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def recorded_max_id(spark: SparkSession, status_path: str | None) -> int:
    """The largest id recorded by a finished run (0 if none)."""
    st = _read(spark, status_path)
    if st is None or "run_max_id" not in st.columns:
        return 0
    return int(st.agg(F.max("run_max_id")).collect()[0][0] or 0)


def _unrecorded(spark: SparkSession, table_path: str | None, base: int) -> DataFrame | None:
    """Chunk rows above the recorded mark: those of a run that stopped after
    writing its chunks but before its status rows. Ids grow run by run and
    each file holds a contiguous id range, so the pushed ``id > base`` skips
    every file of the earlier runs by its min/max statistics: the chunk
    table is never scanned whole."""
    t = _read(spark, table_path, CHUNK_SCHEMA)
    return None if t is None else t.where(F.col("id") > F.lit(int(base)))


def max_id(spark: SparkSession, table_path: str | None, status_path: str | None = None) -> int:
    """Largest id so far (0 for a new table): ids stay unique across
    dimensions, like one shared sequence."""
    base = recorded_max_id(spark, status_path)
    t = _unrecorded(spark, table_path, base)
    if t is None:
        return base
    return max(base, int(t.agg(F.max("id")).collect()[0][0] or 0))


def prepare(docs: DataFrame, parent_col: str, text_col: str, base_meta: Column | None = None,
            dim: int = 384, embedder=None, sep: str = config.PARAGRAPH_SEPARATOR,
            max_tokens: int = config.MAX_TOKENS, overlap_ratio: float = config.WINDOW_OVERLAP_RATIO,
            min_chars: int = config.MIN_PARAGRAPH_CHARS, token_count=None,
            first_id: int = 1, dictionary: str = "simple", drop_failed: bool = False,
            query_col: str | None = None, synonyms: DataFrame | None = None,
            name_col: str | None = None, chunker=None) -> IngestResult:
    """F3/F4 as a plan over all documents at once. With ``query_col`` the
    file's query and its expansion (T12, T13) go into every chunk's metadata.
    ``chunker`` packs in a model's own tokens (``chunking.tokenizer_chunks``).
    A chunk whose text cannot be embedded keeps its row, with a zero vector and
    ``embed_failed``, and its file's status counts it (``n_failed``)."""
    base = base_meta if base_meta is not None else F.lit("{}")
    gated = docs.select(F.col(parent_col).cast("string").alias("parent"), F.col(text_col).alias("_text"),
                        base.alias("_meta"),
                        *( [F.col(query_col).alias("_query")] if query_col else []),
                        *( [F.col(name_col).alias("_name")] if name_col else []),
                        html.text_gate(F.col(text_col)).alias("_gate"))
    ok = gated.where(F.col("_gate") == "ok")
    kw = {} if token_count is None else {"token_count": token_count}
    keys = ["parent", "_meta"] + (["_query"] if query_col else []) + (["_name"] if name_col else [])
    chunks = ch.hierarchical_chunks(ok, "_text", keys,
                                    sep=sep, max_tokens=max_tokens, overlap_ratio=overlap_ratio,
                                    min_chars=min_chars, chunker=chunker, **kw)
    # __parent: the file's original name where given (name_col), else the key
    extra = {"__parent": F.col("_name") if name_col else F.col("parent"),
             "__chunk_index": F.col("chunk_index")}
    if query_col:
        qs = ok.select("parent", "_query").where(F.length("_query") > 0)
        if synonyms is not None:
            exp = expansion.expand_queries(qs, "parent", "_query", synonyms, out="_query_expanded")
        else:
            exp = qs.withColumn("_query_expanded", F.concat(F.col("_query"), F.lit(" ")))
        chunks = chunks.join(exp.select("parent", "_query_expanded"), "parent", "left")
        extra = {"__query": F.col("_query"), "__query_expanded": F.col("_query_expanded"), **extra}
    # __query only where the file has one, its expansion only where non-empty
    meta = jsonb.merge_metadata(F.col("_meta"), extra, optional=("__query", "__query_expanded"))
    with_meta = chunks.withColumn("metadata", meta)
    embedded = emb.embed(with_meta, "content", dim, embedder)
    if drop_failed:
        embedded = embedded.where(~F.col("embed_failed"))
    tsv = ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata")), dictionary)
    # only what the table needs is numbered (and so checkpointed): the
    # optimizer cannot prune columns through the checkpoint
    kept = embedded.select("parent", "chunk_index", "content", "metadata", "embedding", "embed_failed")
    # written before the range partitioning samples it: every chunk is embedded once
    kept = cut_lineage(kept)
    numbered = number_within(kept, [], [F.col("parent"), F.col("chunk_index")], out="_rn")
    out = numbered.select(
        (F.col("_rn") + F.lit(int(first_id) - 1)).cast("long").alias("id"),
        "parent", F.col("chunk_index").cast("int").alias("chunk_index"), "content", "metadata",
        F.try_parse_json("metadata").alias("meta_v"),
        jsonb.hot_keys(F.try_parse_json("metadata")).alias("meta_hot"), "embedding", tsv.alias("tsv"), F.current_timestamp().alias("created_at"),
        "embed_failed", F.lit(int(dim)).alias("dim"))
    # counted from the numbered rows, which are checkpointed: nothing is embedded again
    counts = numbered.groupBy("parent").agg(
        F.count("*").alias("n_chunks"), F.count_if("embed_failed").alias("n_failed"))
    statuses = (gated.select("parent", F.when(F.col("_gate") == "ok", F.lit("processed"))
                             .otherwise(F.lit("error")).alias("status"))
                .join(counts, "parent", "left")
                .select("parent", "status", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                              for c in ("n_chunks", "n_failed")]))
    return IngestResult(out, statuses)


def write_chunks(chunks: DataFrame, table_path: str) -> None:
    """Append, partitioned by dimension. The job commit protocol makes
    the append all-or-nothing per job. Rows built elsewhere get their parsed
    metadata (``meta_v``) here, so every written table has it."""
    if "meta_v" not in chunks.columns:
        chunks = chunks.withColumn("meta_v", F.try_parse_json(F.col("metadata")))
    if "meta_hot" not in chunks.columns:
        chunks = chunks.withColumn("meta_hot", jsonb.hot_keys(F.col("meta_v")))
    if "embed_failed" not in chunks.columns:
        chunks = chunks.withColumn("embed_failed", F.lit(False))
    chunks.write.mode("append").partitionBy("dim").parquet(table_path)


def read_chunks(spark: SparkSession, table_path: str, dim: int | None = None) -> DataFrame:
    """S12 (+ S13): the chunk table, pruned to one dimension partition."""
    df = spark.read.schema(CHUNK_SCHEMA).parquet(table_path)
    return df if dim is None else df.where(F.col("dim") == F.lit(int(dim)))


def ledger(spark: SparkSession, table_path: str, status_path: str) -> DataFrame:
    """every parent already handled: those in the status table (stored,
    rejected or without chunks) and those of chunks above the recorded mark."""
    parts = []
    st = _read(spark, status_path)
    if st is not None:
        parts.append(st.select("parent"))
    t = _unrecorded(spark, table_path, recorded_max_id(spark, status_path))
    if t is not None:
        parts.append(t.select("parent"))
    if not parts:
        return spark.createDataFrame([], "parent string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


MAX_BROADCAST_KEYS = 1_000_000   # input keys broadcast to narrow the ledger


def new_inputs(batch: DataFrame, done: DataFrame, key: str = "parent") -> DataFrame:
    """inputs not handled by an earlier run. The ledger holds every input
    ever handled, so it is first narrowed to this batch's keys (broadcast,
    after a count) with no shuffle of the ledger; the anti-join is then
    against that small set. A batch with more keys than the bound takes the
    plain shuffled anti-join."""
    k = F.col(key).cast("string")
    d = done.select(F.col(key).cast("string").alias("_done"))
    keys = batch.select(k.alias("_k")).distinct()
    if keys.count() <= MAX_BROADCAST_KEYS:
        d = d.join(F.broadcast(keys), F.col("_done") == F.col("_k"), "left_semi")
        return batch.join(F.broadcast(d), k == d["_done"], "left_anti")
    return batch.join(d, k == d["_done"], "left_anti")


def recovered(spark: SparkSession, table_path: str, status_path: str) -> DataFrame | None:
    """Status rows of inputs whose chunks were stored by a run that stopped
    before it wrote its status rows. They go with the next run's own: once the
    recorded mark passes their ids, the ledger still knows them."""
    t = _unrecorded(spark, table_path, recorded_max_id(spark, status_path))
    if t is None:
        return None
    rows = t.groupBy("parent").agg(F.count("*").alias("n_chunks"),
                                   F.count_if("embed_failed").alias("n_failed"))
    return rows.select("parent", F.lit("processed").alias("status"), "n_chunks", "n_failed")


def record_run(spark: SparkSession, statuses: DataFrame, table_path: str, first_id: int,
               status_path: str, **cols: Column) -> None:
    """Append the run's status rows with the largest id it wrote (read back
    from this run's files only)."""
    t = _unrecorded(spark, table_path, int(first_id) - 1)
    top = None if t is None else t.agg(F.max("id")).collect()[0][0]
    run_max = max(int(first_id) - 1, int(top or 0))
    out = statuses.withColumn("run_max_id", F.lit(run_max).cast("long"))
    for k, c in cols.items():
        out = out.withColumn(k, c)
    out.write.mode("append").parquet(status_path)


def run(spark: SparkSession, docs: DataFrame, table_path: str, status_path: str,
        parent_col: str = "parent", text_col: str = "text", **kw) -> IngestResult:
    """ingest everything new in ``docs`` and append it. Re-running with the
    same input adds nothing."""
    done = ledger(spark, table_path, status_path)
    stopped = recovered(spark, table_path, status_path)
    stopped = None if stopped is None else cut_lineage(stopped)
    docs = new_inputs(docs.withColumnRenamed(parent_col, "parent"), done).withColumnRenamed(
        "parent", parent_col)
    first = max_id(spark, table_path, status_path) + 1
    res = prepare(docs, parent_col, text_col, first_id=first, **kw)
    write_chunks(res.chunks, table_path)
    statuses = res.statuses if stopped is None else res.statuses.unionByName(stopped)
    record_run(spark, statuses, table_path, first, status_path)
    return IngestResult(read_chunks(spark, table_path), spark.read.parquet(status_path))
