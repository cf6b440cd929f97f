"""Registered run queries: metrics (A1-A6), ledger (F2), the ingest job
(F3, F4, S11-S14) and the stream (F1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions import jsonb
from quarry.functions import vectors as vec
from quarry.functions.text import WORD_RE
from quarry.functions.util import spread
from quarry.operators import chunking as ch
from quarry.operators import embedding as emb
from quarry.operators import metrics as M
from quarry.operators import search as S
from quarry.plans import ingest
from quarry.plans.chunk_queries import WS_SQL, chunks_ctes
from quarry.plans.oracle_fulltext import search_sql
from quarry.plans.registry import register
from quarry.plans.vector_queries import DIM, hash_embed_sql
from quarry.session import scratch_path
from quarry.sources import html
from quarry.sources.testdata import DOC_CHUNKS_SQL, PARENT_SQL, doc_chunks, parent_name
from quarry.streaming import file_ingest

GATE_SQL = f"length(trim(coalesce(text, ''), {WS_SQL})) >= {config.OCR_THRESHOLD}"


def _statuses(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.when(html.text_gate(F.col("text")) == "ok", F.lit("processed"))
                    .otherwise(F.lit("error")).alias("status"))


@register("run_stats", f"""SELECT CASE WHEN {GATE_SQL} THEN 'processed' ELSE 'error' END AS status,
       count(*) AS n FROM documents GROUP BY ALL""")
def run_stats(spark, sf):
    return M.run_stats(_statuses(spark, sf))


@register("chunks_per_file", chunks_ctes(256, 0.25) + f"""
SELECT d.doc_id, count(c.doc_id) AS n_chunks FROM documents d LEFT JOIN chunks c ON c.doc_id = d.doc_id
WHERE {GATE_SQL.replace('text', 'd.text')} GROUP BY d.doc_id""")
def chunks_per_file(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    ok = d.where(html.text_gate(F.col("text")) == "ok")
    chunks = ch.hierarchical_chunks(ok, "text", ["doc_id"], sep="\n")
    return M.chunks_per_file(ok, chunks, "doc_id")


@register("run_metrics", """SELECT user_id, count(*) AS executions,
       count(*) FILTER (WHERE event_type = 'error') AS failures FROM events GROUP BY user_id""")
def run_metrics(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return M.execution_counts(e, ["user_id"], F.col("event_type") == "error")


def _hist_sql() -> str:
    labels = [(repr(float(b)), float(b)) for b in config.LATENCY_BUCKETS]
    vals = ", ".join(f"('{lab}', {b!r})" for lab, b in labels) + ", ('+Inf', 'inf'::DOUBLE)"
    return f"""
WITH obs AS (SELECT * FROM events WHERE event_type <> 'error'),
tot AS (SELECT event_type, round(sum(value), 6) AS sum_value, count(value) AS count_value FROM obs GROUP BY ALL),
b(le, bound) AS (VALUES {vals}),
cells AS (SELECT t.event_type, b.le, (SELECT count(*) FROM obs o WHERE o.event_type = t.event_type
                                      AND o.value <= b.bound) AS n FROM tot t, b)
SELECT c.event_type, c.le, c.n, t.sum_value, t.count_value FROM cells c JOIN tot t ON t.event_type = c.event_type"""


@register("duration_histogram", _hist_sql())
def duration_histogram(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    h = M.duration_histogram(e, F.col("value"), ["event_type"], F.col("event_type") != "error")
    return h.select("event_type", "le", "n", F.round("sum_value", 6).alias("sum_value"), "count_value")


@register("last_value", "SELECT event_type, arg_max(value, ts) AS last_value FROM events GROUP BY event_type")
def last_value(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return M.last_value(e, F.col("value"), F.col("ts"), ["event_type"])


@register("new_documents", """SELECT doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def new_documents(spark, sf):
    """the labelled documents stand for the ledger of an earlier run."""
    d = spark.read.parquet(f"{sf}/documents.parquet")
    done = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("parent"))
    return ingest.new_inputs(d.select(F.col("doc_id").alias("parent")), done).select(
        F.col("parent").alias("doc_id"))


_INGEST_SQL = chunks_ctes(256, 0.25, where=GATE_SQL) + f""",
cm AS (SELECT c.doc_id, c.chunk_index, c.content, {PARENT_SQL.replace('doc_id', 'c.doc_id')} AS parent,
              json_object('lang', d.lang, 'source', d.source, '__parent', {PARENT_SQL.replace('doc_id', 'c.doc_id')},
                          '__chunk_index', c.chunk_index)::VARCHAR AS metadata
       FROM chunks c JOIN documents d ON d.doc_id = c.doc_id),
""" + hash_embed_sql("cm", "doc_id", "content", extra_keys="chunk_index", prefix="hc") + f"""
SELECT row_number() OVER (ORDER BY cm.parent, cm.chunk_index) AS id, cm.parent, cm.chunk_index,
       md5(cm.content) AS content_md5, cm.metadata, hc.emb_e6,
       len(regexp_extract_all(lower(cm.content), '{WORD_RE}'))
         + len(regexp_extract_all(lower(cm.metadata), '{WORD_RE}')) AS n_tsv, {DIM} AS dim
FROM cm JOIN hc ON hc.doc_id = cm.doc_id AND hc.chunk_index = cm.chunk_index"""


def _ingest_out(chunks):
    return chunks.select("id", "parent", "chunk_index", F.md5("content").alias("content_md5"), "metadata",
                         vec.encode_e6(F.col("embedding")).alias("emb_e6"),
                         F.size("tsv").alias("n_tsv"), "dim")


def _docs_for_ingest(spark, sf):
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    return d.select(parent_name(F.col("doc_id")).alias("parent"), "text",
                    F.to_json(F.struct("lang", "source")).alias("meta"))


@register("ingest_documents", _INGEST_SQL)
def ingest_documents(spark, sf):
    """F3/F4 end to end: gate, chunks, metadata, vectors, text vectors, ids,
    partitioned append; read back from the written table (S11, S12)."""
    table, status = scratch_path(spark, "chunks"), scratch_path(spark, "status")
    ingest.run(spark, _docs_for_ingest(spark, sf), table, status, parent_col="parent",
               text_col="text", base_meta=F.col("meta"), dim=DIM, sep="\n")
    return _ingest_out(ingest.read_chunks(spark, table, DIM))


@register("chunk_table_roundtrip", f"""WITH c AS ({DOC_CHUNKS_SQL})
SELECT id, parent, chunk_index, md5(content) AS content_md5, metadata, len(embedding) AS dims FROM c""")
def chunk_table_roundtrip(spark, sf):
    """Write the chunk table partitioned by dimension, read it back
    pruned to the 64 partition."""
    c = doc_chunks(spark, sf)
    rows = c.select("id", "parent", F.col("chunk_index").cast("int").alias("chunk_index"), "content",
                    "metadata", "embedding",
                    ft.text_vector(F.col("content"), jsonb.jsonb_text(F.col("metadata"))).alias("tsv"),
                    F.current_timestamp().alias("created_at"),
                    F.size("embedding").cast("int").alias("dim"))
    path = scratch_path(spark, "chunk-table")
    ingest.write_chunks(rows, path)
    t = ingest.read_chunks(spark, path, DIM)
    return t.select("id", "parent", "chunk_index", F.md5("content").alias("content_md5"), "metadata",
                    F.size("embedding").alias("dims"))


@register("stream_ingest", chunks_ctes(256, 0.25, where=GATE_SQL)
          + "\nSELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY doc_id")
def stream_ingest(spark, sf):
    """the documents table, one file or a folder of files, picked up by a
    file-source stream (availableNow) and ingested batch by batch; a second run
    over the same files and checkpoint adds nothing. Chunks per parent, read back."""
    base = scratch_path(spark, "stream")
    table, status, ckpt = f"{base}/chunks", f"{base}/status", f"{base}/checkpoint"
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    kw = dict(parent_col="doc_id", text_col="text", dim=DIM, sep="\n")
    for _ in range(2):
        file_ingest.run_once(spark, file_ingest.table_files(f"{sf}/documents.parquet"), schema,
                             table, status, ckpt, fmt="parquet", **kw)
    t = ingest.read_chunks(spark, table)
    return t.groupBy(F.col("parent").cast("bigint").alias("doc_id")).agg(F.count("*").alias("n_chunks"))


@register("recovered_ingest", chunks_ctes(256, 0.25, where=GATE_SQL)
          + "\nSELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY doc_id")
def recovered_ingest(spark, sf):
    """a run that stops between its chunks and its status rows, then two
    whole runs over all documents (rejects among them): nothing is missing,
    nothing is stored twice."""
    table, status = scratch_path(spark, "chunks"), scratch_path(spark, "status")
    d = spread(spark.read.parquet(f"{sf}/documents.parquet")).select(
        F.col("doc_id").cast("string").alias("parent"), "text")
    kw = dict(dim=DIM, sep="\n")
    stopped = ingest.prepare(d.where("cast(parent AS bigint) % 3 = 0"), "parent", "text", **kw)
    ingest.write_chunks(stopped.chunks, table)
    for _ in range(2):
        ingest.run(spark, d, table, status, **kw)
    return (ingest.read_chunks(spark, table).groupBy(F.col("parent").cast("bigint").alias("doc_id"))
            .agg(F.count("*").alias("n_chunks")))


# Q7 on ingest's own output: the written chunk table (stored text vectors and
# VARIANT metadata) searched with a hashed query vector and a JSON filter.
_INGESTED_CHUNKS_SQL = _INGEST_SQL.split("\nSELECT row_number()")[0] + """
SELECT row_number() OVER (ORDER BY cm.parent, cm.chunk_index) AS id, cm.content, cm.metadata,
       hc.v AS embedding
FROM cm JOIN hc ON hc.doc_id = cm.doc_id AND hc.chunk_index = cm.chunk_index"""
_BENCH_QV_SQL = ("(WITH " + hash_embed_sql("benchmark", "item_id", "text", prefix="hq")
                 + "\nSELECT v::DOUBLE[] FROM hq WHERE item_id = 0)")


@register("search_ingested", search_sql(_INGESTED_CHUNKS_SQL, _BENCH_QV_SQL, "at by",
                                        filter_json='{"lang": "en"}'))
def search_ingested(spark, sf):
    """S11 -> S12 -> Q7: ingest the documents, then the filtered hybrid search
    over the written table, the way a deployment runs it."""
    table, status = scratch_path(spark, "chunks"), scratch_path(spark, "status")
    ingest.run(spark, _docs_for_ingest(spark, sf), table, status, parent_col="parent",
               text_col="text", base_meta=F.col("meta"), dim=DIM, sep="\n")
    b = spark.read.parquet(f"{sf}/benchmark.parquet").where(F.col("item_id") == 0)
    qv = [float(x) for x in emb.embed(b, "text", DIM).select("embedding").collect()[0][0]]
    out = S.match_hybrid(ingest.read_chunks(spark, table, DIM), qv, "at by",
                         filter={"lang": "en"}, dims=(DIM,))
    return out.select("id", "content", "metadata", F.round("score", 6).alias("score"))
