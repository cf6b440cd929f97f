"""The driver's tables and the views derived from them.

``doc_chunks`` is the chunk table of the search queries: one chunk per
document, its vector from ``embeddings`` (``vec_id`` = ``doc_id`` modulo their
number), metadata the JSON of ``lang, source, __parent``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table


def parent_name(doc_id) -> F.Column:
    return F.concat(F.lit("doc_"), doc_id.cast("string"), F.lit(".pdf"))


PARENT_SQL = "'doc_' || CAST(doc_id AS VARCHAR) || '.pdf'"


def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    e = table(spark, sf_dir, "embeddings")
    parent = parent_name(F.col("doc_id"))
    meta = F.to_json(F.struct(F.col("lang"), F.col("source"), parent.alias("__parent")))
    n = max(e.count(), 1)  # documents beyond the stored vectors take them over in turn
    return (d.join(e, F.pmod(d.doc_id, F.lit(n)) == e.vec_id)
             .select(F.col("doc_id").alias("id"), parent.alias("parent"),
                     F.lit(0).alias("chunk_index"), F.col("text").alias("content"),
                     meta.alias("metadata"), F.col("embedding")))


DOC_CHUNKS_SQL = f"""
SELECT d.doc_id AS id, {PARENT_SQL} AS parent, 0 AS chunk_index, d.text AS content,
       json_object('lang', d.lang, 'source', d.source, '__parent', {PARENT_SQL})::VARCHAR AS metadata,
       e.embedding AS embedding
FROM documents d JOIN embeddings e ON d.doc_id % (SELECT count(*) FROM embeddings) = e.vec_id
"""


def query_vector(spark: SparkSession, sf_dir: str, vec_id: int = 0) -> list[float]:
    """One stored vector as a query literal (a single row to the driver)."""
    row = (table(spark, sf_dir, "embeddings").where(F.col("vec_id") == vec_id)
           .select("embedding").limit(1).collect())
    if not row:
        raise ValueError(f"no vector {vec_id}")
    return [float(x) for x in row[0][0]]


def query_vector_sql(vec_id: int = 0) -> str:
    return f"(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = {vec_id})"


# Paths of the documents as if they were files in a folder tree: one folder
# per document below its source; the name from language and size (so equal
# names occur in different folders); French documents already in an archive
# folder; short ones with a type that is not accepted; Spanish names with a
# blank before the extension.
PATH_ROOT = "/data"


def doc_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    ext = (F.when(F.col("n_chars") < 300, F.lit(".txt"))
            .when(F.col("lang") == "en", F.lit(".pdf"))
            .when(F.col("lang") == "de", F.lit(".PDF"))
            .when(F.col("lang") == "es", F.lit(" .docx"))
            .otherwise(F.lit(".png")))
    folder = F.concat(F.lit(PATH_ROOT + "/"), F.col("source"),
                      F.when(F.col("lang") == "fr", F.lit("/Processado")).otherwise(F.lit("")),
                      F.lit("/d"), F.col("doc_id").cast("string"))
    name = F.concat(F.col("lang"), F.lit("_"), F.floor(F.col("n_chars") / 1000).cast("string"), ext)
    return d.select("doc_id", F.concat(folder, F.lit("/"), name).alias("path"))


DOC_PATHS_SQL = f"""
SELECT doc_id,
       '{PATH_ROOT}/' || source || CASE WHEN lang = 'fr' THEN '/Processado' ELSE '' END
       || '/d' || CAST(doc_id AS VARCHAR) || '/' || lang || '_' || CAST(floor(n_chars / 1000) AS BIGINT)
       || CASE WHEN n_chars < 300 THEN '.txt' WHEN lang = 'en' THEN '.pdf' WHEN lang = 'de' THEN '.PDF'
               WHEN lang = 'es' THEN ' .docx' ELSE '.png' END AS path
FROM documents"""
