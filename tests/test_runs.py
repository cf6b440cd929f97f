"""Ingest job, ledger and file stream (F1-F4, S11-S14); the driver contract."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.plans import ingest
from quarry.streaming import file_ingest
from tests.conftest import SF


def docs(spark):
    return spark.createDataFrame(
        [("a.pdf", "short"), ("b.pdf", ("A paragraph long enough to be kept by the filter. " * 3 + "\n\n") * 3),
         ("c.pdf", "SUMÁRIO\n\n" + "x " * 60)], "parent string, text string")


def test_ingest_run_twice_adds_nothing(spark, scratch):
    t, s = scratch + "/chunks", scratch + "/status"
    r1 = ingest.run(spark, docs(spark), t, s, dim=8, max_tokens=40)
    n1 = r1.chunks.count()
    ids = [r.id for r in r1.chunks.orderBy("id").collect()]
    assert ids == list(range(1, n1 + 1))
    st = {r.parent: (r.status, r.n_chunks) for r in r1.statuses.collect()}
    assert st["a.pdf"] == ("error", 0) and st["b.pdf"][0] == "processed" and st["c.pdf"][0] == "processed"
    r2 = ingest.run(spark, docs(spark), t, s, dim=8, max_tokens=40)
    assert r2.chunks.count() == n1
    meta = r1.chunks.where(F.col("parent") == "b.pdf").orderBy("chunk_index").first().metadata
    assert '"__parent":"b.pdf"' in meta and '"__chunk_index":0' in meta
    assert ingest.read_chunks(spark, t, 8).count() == n1 and ingest.read_chunks(spark, t, 16).count() == 0


def test_stream_rerun_and_new_file(spark, scratch):
    src = scratch + "/in"
    os.makedirs(src)
    docs(spark).limit(2).coalesce(1).write.mode("overwrite").parquet(src + "/one")
    kw = dict(parent_col="parent", text_col="text", dim=8, max_tokens=40)
    a = (spark, src + "/one", docs(spark).schema, scratch + "/t", scratch + "/s", scratch + "/ck")
    file_ingest.run_once(*a, **kw)
    n1 = ingest.read_chunks(spark, scratch + "/t").count()
    file_ingest.run_once(*a, **kw)
    assert ingest.read_chunks(spark, scratch + "/t").count() == n1
    docs(spark).where(F.col("parent") == "c.pdf").coalesce(1).write.mode("append").parquet(src + "/one")
    file_ingest.run_once(*a, **kw)
    t = ingest.read_chunks(spark, scratch + "/t")
    assert t.count() > n1 and t.select("id").distinct().count() == t.count()


def test_stream_over_a_table_of_files(spark, scratch):
    """the documents table may be one file or a folder of files."""
    import __spark_entry__ as E
    text = "A paragraph long enough to be kept by the filter. " * 3
    rows = spark.createDataFrame([(i, text) for i in range(6)] + [(None, text), (7, None)], "doc_id long, text string")
    rows.repartition(3).write.parquet(scratch + "/many/documents.parquet")
    rows.coalesce(1).write.parquet(scratch + "/part")
    os.makedirs(scratch + "/one")
    part = next(f for f in os.listdir(scratch + "/part") if f.endswith(".parquet"))
    os.link(f"{scratch}/part/{part}", scratch + "/one/documents.parquet")
    for sf in ("many", "one"):
        os.makedirs(f"{scratch}/{sf}/documents.parquet.old")
        got = {r.doc_id: r.n_chunks for r in E.queries()["stream_ingest"](spark, f"{scratch}/{sf}").collect()
               if r.doc_id is not None}
        assert got == dict.fromkeys(range(6), 1), sf


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["id", "content", "metadata", "score"]
    assert 0 < df.count() <= 5
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 80
    from quarry.plans.registry import ORACLES, QUERIES
    assert set(QUERIES) <= set(qs) and set(QUERIES) - set(ORACLES) == {"ivf_probe", "lsh_knn"}
    assert os.path.isdir(SF)


def test_query_expansion_in_every_chunk(spark):
    """The file's query and its expansion are in the metadata of every
    chunk of that file; files without a query get neither key."""
    import json
    d = docs(spark).withColumn("q", F.when(F.col("parent") == "b.pdf", F.lit("Paragraph filter"))
                                     .otherwise(F.lit(None)))
    syn = spark.createDataFrame([("paragraph", 1, 1, "passage"), ("paragraph", 1, 2, "para_graph"),
                                 ("filter", 1, 1, "sieve")],
                                "token string, synset_rank int, lemma_rank int, lemma string")
    res = ingest.prepare(d, "parent", "text", dim=8, max_tokens=40, query_col="q", synonyms=syn)
    rows = res.chunks.select("parent", "chunk_index", "metadata").collect()
    b = [json.loads(r.metadata) for r in rows if r.parent == "b.pdf"]
    assert len(b) > 1
    assert all(m["__query"] == "Paragraph filter" for m in b)
    assert all(m["__query_expanded"] == "Paragraph filter para graph passage sieve" for m in b)
    assert all(m["__parent"] == "b.pdf" for m in b)
    assert sorted(m["__chunk_index"] for m in b) == list(range(len(b)))
    others = [json.loads(r.metadata) for r in rows if r.parent != "b.pdf"]
    assert all("__query" not in m for m in others)


def test_rerun_after_stop_between_writes(spark, scratch):
    """A run that wrote its chunks but not its status rows: the next run sees
    those parents through the chunks above the recorded mark, adds nothing
    for them, and continues the ids after them."""
    t, s = scratch + "/chunks", scratch + "/status"
    first = ingest.run(spark, docs(spark).where(F.col("parent") == "c.pdf"), t, s, dim=8, max_tokens=40)
    n0 = first.chunks.count()
    mark = ingest.recorded_max_id(spark, s)
    assert mark == n0
    res = ingest.prepare(docs(spark).where(F.col("parent") == "b.pdf"), "parent", "text", dim=8,
                         max_tokens=40, first_id=mark + 1)
    ingest.write_chunks(res.chunks, t)          # ...and stop before the status rows
    n1 = ingest.read_chunks(spark, t).count()
    assert n1 > n0 and ingest.max_id(spark, t, s) == n1
    again = ingest.run(spark, docs(spark), t, s, dim=8, max_tokens=40)
    rows = again.chunks.collect()
    assert sum(r.parent == "b.pdf" for r in rows) == n1 - n0        # b.pdf not added twice
    ids = sorted(r.id for r in rows)
    assert ids == list(range(1, len(ids) + 1))
    plan = ingest._unrecorded(spark, t, mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id," in plan                                 # pushed into the scan


def test_stopped_run_stays_known_after_two_more(spark, scratch):
    """The recovering run records the stopped run's inputs, so a third run,
    after the mark has passed their ids, does not take them again."""
    t, s = scratch + "/chunks", scratch + "/status"
    d = docs(spark).unionByName(spark.createDataFrame([("short.pdf", "too short")], "parent string, text string"),
                                allowMissingColumns=True)
    res = ingest.prepare(d.where("parent = 'b.pdf'"), "parent", "text", dim=8, max_tokens=40)
    ingest.write_chunks(res.chunks, t)                               # ...and stop
    counts = []
    for _ in range(3):
        out = ingest.run(spark, d, t, s, dim=8, max_tokens=40)
        counts.append((out.chunks.count(), out.statuses.count(), out.statuses.select("parent").distinct().count()))
    assert counts[0] == counts[1] == counts[2] and counts[0][1] == counts[0][2] == d.count()
    row = out.statuses.where("parent = 'b.pdf'").first()
    assert row.status == "processed" and row.n_chunks == out.chunks.where("parent = 'b.pdf'").count()


def test_only_a_missing_table_counts_as_none(spark, scratch):
    import os
    assert ingest._read(spark, scratch + "/absent") is None
    os.makedirs(scratch + "/bad")
    with open(scratch + "/bad/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        ingest._read(spark, scratch + "/bad")


def test_every_chunk_is_embedded_and_every_file_decoded_once(spark, scratch):
    import os
    import uuid

    import numpy as np
    from quarry.operators import embedding as emb
    from quarry.sources import files
    calls = scratch + "/calls"
    os.makedirs(calls)

    def note(kind, n):
        for _ in range(n):
            open(f"{calls}/{kind}-{uuid.uuid4().hex}", "w").close()

    def load():
        def encode(texts):
            note("embed", len(texts))
            return np.ones((len(texts), 4), dtype=np.float32)
        return encode

    def decode(data, path):
        note("decode", 1)
        return data.decode()

    root = scratch + "/in"
    os.makedirs(root)
    for i in range(5):
        with open(f"{root}/f{i}.pdf", "w") as f:
            f.write((f"Paragraph number {i} is long enough for the gate and for the chunker to keep it. " * 2
                     + "\n") * (i + 1))
    file_ingest.run_once(spark, root, None, scratch + "/c", scratch + "/s", scratch + "/k", "parent", "text",
                         fmt="binaryFile", extract=lambda df, done: files.file_documents(df, root, decode, done),
                         name_col="name", dim=4, sep="\n", max_tokens=16, embedder=emb.model_embedder(load, 4))
    n = ingest.read_chunks(spark, scratch + "/c").count()
    made = [x.split("-")[0] for x in os.listdir(calls)]
    assert n > 5 and made.count("embed") == n and made.count("decode") == 5


def test_one_failing_text_costs_one_vector(spark, scratch):
    import numpy as np
    from quarry.operators import embedding as emb

    def load():
        def encode(texts):
            if any("POISON" in x for x in texts):
                raise ValueError("cannot encode")
            return np.ones((len(texts), 4), dtype=np.float32)
        return encode

    long = "A paragraph that is long enough to be kept as one chunk of its own, with words. "
    d = spark.createDataFrame([(f"p{i}.pdf", long * 3 + ("POISON " if i == 3 else "")) for i in range(6)],
                              "parent string, text string").coalesce(1)
    out = ingest.run(spark, d, scratch + "/c", scratch + "/s", dim=4, embedder=emb.model_embedder(load, 4))
    rows = out.chunks.collect()
    assert len(rows) == 6 and [r.parent for r in rows if r.embed_failed] == ["p3.pdf"]
    assert all(list(r.embedding) == [0.0 if r.embed_failed else 1.0] * 4 for r in rows)
    assert {r.parent: r.n_failed for r in out.statuses.collect()} == {f"p{i}.pdf": int(i == 3) for i in range(6)}


def test_stored_variant_metadata_filters_like_text(spark, scratch):
    """The chunk table keeps the metadata parsed (``meta_v``); a filtered
    search over it equals the search over the JSON text alone."""
    from quarry.operators import search as S
    t, s = scratch + "/chunks", scratch + "/status"
    d = docs(spark).withColumn("meta", F.when(F.col("parent") == "b.pdf", F.lit('{"lang": "en", "n": 1}'))
                               .otherwise(F.lit('{"lang": "de"}')))
    res = ingest.run(spark, d, t, s, dim=8, max_tokens=40, base_meta=F.col("meta"))
    chunks = ingest.read_chunks(spark, t, 8)
    assert chunks.where(F.col("meta_v").isNull()).count() == 0
    q = [1.0] * 8
    with_v = S.vector_pool(chunks, q, 50, {"lang": "en", "n": 1}).collect()
    text_only = S.vector_pool(chunks.drop("meta_v"), q, 50, {"lang": "en", "n": 1}).collect()
    assert [r.id for r in with_v] == [r.id for r in text_only] and len(with_v) > 0
    assert res.statuses.count() == 3


def test_folder_of_files_stream(spark, scratch):
    """F1/F3/F4 over raw files: accepted types only, the archive folder
    skipped, names cleaned, a failing or short file marked 'error', equal
    base names in two folders both kept; a re-run adds nothing and a new
    file is picked up alone."""
    import json
    from quarry.sources import files
    root = scratch + "/in"
    long_text = ("A long enough paragraph of plain text for the gate and the chunker. " * 3 + "\n") * 2
    put = {"a/one.pdf": long_text, "a/two .PDF": long_text.upper(), "b/one.pdf": long_text + "b",
           "Processado/old.pdf": long_text, "c/short.pdf": "too short", "c/notes.txt": long_text}
    for rel, text in put.items():
        os.makedirs(os.path.dirname(f"{root}/{rel}"), exist_ok=True)
        with open(f"{root}/{rel}", "w") as fh:
            fh.write(text)
    with open(f"{root}/c/bad.pdf", "wb") as fh:
        fh.write(b"\xff\xfe not utf-8 " * 20)
    t, s, ck = scratch + "/chunks", scratch + "/status", scratch + "/ck"

    def run():
        file_ingest.run_once(spark, root, None, t, s, ck, fmt="binaryFile", parent_col="parent",
                             text_col="text", name_col="name", dim=8, max_tokens=40,
                             extract=lambda df, done: files.file_documents(
                                 df, root, lambda b, p: b.decode("utf-8"), done))
    run()
    st = {r.parent.split("/in/")[1]: r.status for r in spark.read.parquet(s).collect()}
    assert st == {"a/one.pdf": "processed", "a/two.PDF": "processed", "b/one.pdf": "processed",
                  "c/short.pdf": "error", "c/bad.pdf": "error"}
    rows = ingest.read_chunks(spark, t).collect()
    names = {r.parent.split("/in/")[1]: json.loads(r.metadata)["__parent"] for r in rows}
    assert names == {"a/one.pdf": "one.pdf", "a/two.PDF": "two .PDF", "b/one.pdf": "one.pdf"}
    n = len(rows)
    run()
    assert ingest.read_chunks(spark, t).count() == n
    with open(f"{root}/b/three.pdf", "w") as fh:
        fh.write(long_text)
    run()
    after = ingest.read_chunks(spark, t).collect()
    assert {r.parent.split("/in/")[1] for r in after} - set(names) == {"b/three.pdf"}
    assert sorted(r.id for r in after) == list(range(1, len(after) + 1))


def test_ledger_is_narrowed_not_shuffled(spark):
    """the ledger is semi-joined with the broadcast batch keys, so it is
    never the shuffled side of the anti-join."""
    done = spark.range(5000).select(F.col("id").cast("string").alias("parent"))
    batch = spark.createDataFrame([("7", "x"), ("new", "y")], "parent string, text string")
    out = ingest.new_inputs(batch, done)
    assert [r.parent for r in out.collect()] == ["new"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_hot_metadata_key_reaches_the_scan(spark, scratch):
    """A filter on an indexed key (``__parent``) is also an equality on the
    ``meta_hot`` column, pushed to the Parquet scan; same rows as the
    containment test alone."""
    from quarry.operators import search as S
    t, s = scratch + "/chunks", scratch + "/status"
    ingest.run(spark, docs(spark), t, s, dim=8, max_tokens=40)
    chunks = ingest.read_chunks(spark, t, 8)
    filt = {"__parent": "b.pdf"}
    pool = S.vector_pool(chunks, [1.0] * 8, 50, filt)
    plan = pool._jdf.queryExecution().executedPlan().toString()
    assert "meta_hot.__parent" in plan.split("PushedFilters")[1].split("]")[0]
    plain = S.vector_pool(chunks.drop("meta_hot", "meta_v"), [1.0] * 8, 50, filt).collect()
    got = pool.collect()
    assert [r.id for r in got] == [r.id for r in plain] and len(got) > 0
    assert {r.parent for r in chunks.where(chunks.id.isin([r.id for r in got])).collect()} == {"b.pdf"}
