"""The training-data pipeline over ``documents``: what the quality classifier
rejects goes, repeated lines go, one document of each group of near copies
stays, contaminated documents go, and the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again before the next stage, so a lost executor
never sets the pipeline back by more than the stage it is in. All stages but
the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, linededup, packing, quality, simhash
from quarry.llm.common import in_fold, materialise
from quarry.session import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality; labels of fold 1 of 3 are held out."""
    labels = table(spark, sf_dir, "labels").where(~in_fold("doc_id", 3, 1))
    return quality.keep_good(docs, labels)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line at its earliest place only; documents left without any go."""
    return linededup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked fingerprints."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality classifier", keep_quality), ("line dedup", drop_repeated_lines),
          ("simhash near-dedup", drop_near_copies), ("benchmark decontamination", drop_contaminated),
          ("best-fit packing", pack_sequences)]

#: Marginals of a learned model and the tokenizer cannot be written in SQL; the
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
