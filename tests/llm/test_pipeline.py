import pytest

import corpus_pipeline as pipeline
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_simhash import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(pipeline.STAGES):
        new = stage(spark, docs, SF)
        rows = new.collect()
        out.append((docs.orderBy("doc_id").collect(), rows))
        if k + 1 < len(pipeline.STAGES):
            assert new.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_order():
    assert [f for _, f in pipeline.STAGES] == [
        pipeline.keep_quality, pipeline.drop_repeated_lines, pipeline.drop_near_copies,
        pipeline.drop_contaminated, pipeline.pack_sequences]


def test_quality_stage(spark, stages):
    before, after = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    known = [r.doc_id for r in before if r.doc_id in labels]
    assert sum((d in kept) == (labels[d] == 1) for d in known) >= 0.95 * len(known)


def test_line_stage(stages):
    before, after = stages[1]
    want = brute_lines([r.text for r in before])
    texts = {r.doc_id: r.text for r in after}
    for i, r in enumerate(before):
        stay = [x for n, x in enumerate(r.text.split("\n")) if (i, n) not in want]
        if any(x.strip(" \t\r") for x in stay):
            assert texts[r.doc_id] == "\n".join(stay)
        else:
            assert r.doc_id not in texts


def test_near_copy_stage(stages):
    before, after = stages[2]
    ids = [r.doc_id for r in before]
    want = set(brute_groups(ids, [brute_fp(r.text) for r in before]))
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_contamination_stage(spark, stages):
    before, after = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet")
             .select("item_id", "text").collect()]
    found = brute_contamination([r.text for r in before], items)
    assert sorted(r.doc_id for r in after) == [r.doc_id for r, f in zip(before, found) if not f[1]]


def test_packing_stage(stages):
    before, after = stages[4]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    used = {}
    for r in after:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 4096
    assert len(used) <= -(-sum(used.values()) // 4096) + 1


def test_run_and_edge_rows(spark, make_docs, write_tables):
    docs = make_docs([None, "", "a b", "a b", "one two three four five six"]).selectExpr(
        "*", "1 AS score", "2 AS fp", "3 AS component_id", "4 AS dk")
    sf = write_tables(documents=docs, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                      benchmark=spark.createDataFrame([(1, "one two three")], "item_id long, text string"))
    rows = pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == [0, 2]  # null and empty texts are one group
    empty = make_docs([])
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
