"""Top-k text search over postings in blocks (L11), with block-max skipping.

The rank of an or-query is the mean over its lexemes of what each contributes,
and a lexeme's contribution, its impact, depends on the document's occurrences of
it alone (``fulltext.rank_or_data``). The index holds the impact of every lexeme in
every document, documents dealt into blocks, and per lexeme and block the greatest
impact and the number of postings.

A query's bound in a block is the sum of its lexemes' greatest impacts there. The
blocks with the best bounds are scored first, then four times as many, and so on,
of each wave those whose bound reaches the k-th best score so far. Where a wave
has none left, no later block holds anything better and its postings are not
read: the answer equals a full scan.

A frequent lexeme is many rows of many blocks, sorted into ranges of (lexeme,
block); nothing of a lexeme's size meets in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import fulltext as ft
from quarry.functions.util import slices
from quarry.session import scratch_path

BLOCK_DOCS = 32
FIRST_BLOCKS = 8
#: Scores are compared to this many decimals; bounds get one unit of grace.
DECIMALS = 9


def impacts(most: int) -> np.ndarray:
    """Contributions of 0 to ``most`` occurrences of weight A to an or-query's rank."""
    j = np.arange(1, most + 1, dtype=np.float64)
    return np.concatenate([[0.0], np.cumsum(1.0 / (j * j)) / ft.ZETA2])


def word_counts(docs: DataFrame, key: str, text_col: str, dictionary: str = "simple") -> DataFrame:
    """(key, lexeme, n, impact): occurrences counted within the document's row, so each
    lexeme of a document is one row before anything is shuffled. A batch's words are
    numbered once and counted as numbers."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in slices(batches):
            ids, rows = b.column(0), b.column(1)
            words = rows.flatten().dictionary_encode()
            width = max(1, len(words.dictionary))
            doc = np.repeat(np.arange(len(rows), dtype=np.int64), pc.fill_null(pc.list_value_length(rows), 0))
            seen, n = np.unique(doc * width + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
            at, word = np.divmod(seen, width)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), words.dictionary.take(pa.array(word)), pa.array(n.astype(np.int64)),
                 pa.array(impacts(int(n.max(initial=0)))[n])], [key, "lexeme", "n", "impact"])

    return docs.select(key, ft.words(F.col(text_col), dictionary).alias("ws")).mapInArrow(
        run, f"{key} {kind}, lexeme string, n long, impact double")


def build(docs: DataFrame, path: str, key: str, text_col: str, dictionary: str = "simple",
          block_docs: int = BLOCK_DOCS) -> None:
    """Write ``path``/postings (lexeme, block, key, n, impact) and ``path``/blocks
    (lexeme, block, most, n), sorted by lexeme and block."""
    n_blocks = max(1, -(-docs.count() // block_docs))
    counts, spark = word_counts(docs, key, text_col, dictionary), docs.sparkSession
    block = F.pmod(F.xxhash64(key), F.lit(n_blocks))
    # ranges are drawn from rows: from written ones, or the texts are split for it once more
    made = scratch_path(spark, "counted")
    counts.select("lexeme", block.alias("block"), key, "n", "impact").write.parquet(made)
    (spark.read.parquet(made).repartitionByRange("lexeme", "block").sortWithinPartitions("lexeme", "block", key)
     .write.mode("overwrite").parquet(f"{path}/postings"))
    postings = spark.read.parquet(f"{path}/postings")
    made = scratch_path(spark, "blocks")
    (postings.groupBy("lexeme", "block").agg(F.max("impact").alias("most"), F.count("*").alias("n"))
     .write.parquet(made))
    (spark.read.parquet(made).repartitionByRange("lexeme", "block").sortWithinPartitions("lexeme", "block")
     .write.mode("overwrite").parquet(f"{path}/blocks"))


def search(spark: SparkSession, path: str, queries: DataFrame, key: str, k: int,
           first_blocks: int = FIRST_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """For queries (qid, lexemes: array), the ``k`` best documents above 0 of each:
    (qid, key, score, rank), and per query how many postings its lexemes have and
    how many were read: (qid, postings, read)."""
    postings, blocks = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "blocks"))
    terms = queries.select("qid", F.explode(F.array_distinct("lexemes")).alias("lexeme"),
                           F.size(F.array_distinct("lexemes")).alias("of"))
    bounds = (terms.join(blocks, "lexeme").groupBy("qid", "block")
              .agg((F.sum("most") / F.max("of")).alias("bound"), F.sum("n").alias("n")))
    # waves join the postings of the queries' lexemes, which are picked once
    wanted = scratch_path(spark, "asked-postings")
    (postings.join(F.broadcast(terms.select("lexeme").distinct()), "lexeme", "left_semi")
     .select("lexeme", "block", key, "impact").write.parquet(wanted))
    postings = spark.read.parquet(wanted)
    order = Window.partitionBy("qid").orderBy(F.desc("bound"), "block")
    bounds = bounds.withColumn("place", F.row_number().over(order)).checkpoint()
    best = Window.partitionBy("qid").orderBy(F.desc("score"), key)

    def scored(chosen):
        hits = terms.join(chosen.select("qid", "block"), "qid").join(postings, ["lexeme", "block"])
        return hits.groupBy("qid", key).agg(F.round(F.sum("impact") / F.max("of"), DECIMALS).alias("score"))

    none = spark.createDataFrame([], queries.select("qid").schema)
    found = none.select("qid", F.lit(None).cast(postings.schema[key].dataType).alias(key), F.lit(0.0).alias("score"))
    read = none.select("qid", F.lit(0).cast("long").alias("n"))
    done, width = 0, first_blocks
    while True:
        least = (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
                 .select("qid", F.col("score").alias("least")))
        wave = bounds.where((F.col("place") > done) & (F.col("place") <= done + width)).join(least, "qid", "left")
        wave = wave.where(F.col("bound") + 10.0 ** -DECIMALS >= F.coalesce("least", F.lit(0.0)))
        wave = wave.select("qid", "block", "n").checkpoint()
        if wave.isEmpty():  # bounds only fall from here on
            break
        found = (found.unionByName(scored(wave)).withColumn("rank", F.row_number().over(best))
                 .where(F.col("rank") <= k).drop("rank").checkpoint())
        read = read.unionByName(wave.select("qid", "n"))
        done, width = done + width, 4 * width
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("score") > 0)
    read = read.groupBy("qid").agg(F.sum("n").alias("read"))
    told = bounds.groupBy("qid").agg(F.sum("n").alias("postings")).join(read, "qid")
    return top.select("qid", key, "score", "rank"), told
