"""Incremental ingest as a file-source stream.

New files in a folder are picked up by Structured Streaming; the stream's
checkpoint remembers which files were read, so a re-run over the same
folder adds nothing. ``trigger(availableNow=True)`` processes what is there
and stops, which is the batch-style re-run of the folder walk. Each
micro-batch goes through the same ingest plan and is appended; the batch id
is stored with the status rows, and a batch already stored is skipped, so a
retried batch is not appended twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.util import spread
from quarry.plans import ingest
from quarry.session import cut_lineage


def _batch_done(spark: SparkSession, status_path: str, batch_id: int) -> bool:
    """Whether a retried micro-batch was already stored (one pruned lookup,
    not the set of all batch ids on the driver)."""
    st = ingest._read(spark, status_path)
    if st is None or "batch_id" not in st.columns:
        return False
    return st.where(F.col("batch_id") == F.lit(int(batch_id))).limit(1).count() > 0


BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def table_files(path: str) -> str:
    """``path`` as a pattern that only it matches: a stream over a pattern takes
    one file as well as a folder of them, over a plain path folders alone."""
    return f"{path[:-1]}[{path[-1]}]"


def start(spark: SparkSession, source_dir: str, schema: T.StructType | None, table_path: str,
          status_path: str, checkpoint: str, parent_col: str, text_col: str,
          fmt: str = "parquet", glob: str | None = None, available_now: bool = True,
          max_files_per_trigger: int | None = None,
          extract: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
          **prepare_kw) -> StreamingQuery:
    """Ingest the files of ``source_dir`` as they arrive. Rows are documents
    (``parent_col``, ``text_col``), or, with ``extract(batch, done)``, turned
    into documents per micro-batch (raw files: ``fmt="binaryFile"`` and
    ``sources.files.file_documents``; ``done`` is the ledger, so handled
    files are left out before decoding)."""
    if schema is None and fmt == "binaryFile":
        schema = BINARY_FILE_SCHEMA
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "binaryFile":
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(source_dir)

    def batch(df: DataFrame, batch_id: int) -> None:
        if _batch_done(spark, status_path, batch_id):
            return
        done = ingest.ledger(spark, table_path, status_path)
        docs = spread(df)
        if extract is not None:
            docs = cut_lineage(extract(docs, done))  # each file is decoded once
        docs = ingest.new_inputs(docs.withColumnRenamed(parent_col, "parent"), done) \
            .withColumnRenamed("parent", parent_col)
        stopped = ingest.recovered(spark, table_path, status_path)
        stopped = None if stopped is None else cut_lineage(stopped)
        first = ingest.max_id(spark, table_path, status_path) + 1
        res = ingest.prepare(docs, parent_col, text_col, first_id=first, **prepare_kw)
        ingest.write_chunks(res.chunks, table_path)
        statuses = res.statuses if stopped is None else res.statuses.unionByName(stopped)
        ingest.record_run(spark, statuses, table_path, first, status_path,
                          batch_id=F.lit(int(batch_id)).cast("long"))

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_once(spark: SparkSession, *args, **kw) -> None:
    """Process every file present now, then stop."""
    q = start(spark, *args, available_now=True, **kw)
    q.awaitTermination()
