import zlib

from quarry.llm import queries, sharding


def test_law_mixture_and_determinism(spark, make_docs, write_tables):
    texts = [None, "", "same", "same"] + [f"text {i} é" for i in range(1_000)]
    docs = make_docs(texts).selectExpr("doc_id", "text", "lang", "n_chars", "1 AS place", "2 AS _n",
                                       "if(doc_id < 400, 'hot', if(doc_id < 410, null, source)) AS source")
    sf = write_tables(documents=docs)
    rows = queries.op6_stratified_shards(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    by = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
        by.setdefault(r.shard, []).append(r)
    counts = [len(v) for v in by.values()]
    assert set(by) == set(range(40)) and max(counts) - min(counts) <= 1
    source = {r.doc_id: r.source for r in docs.collect()}
    for name in set(source.values()):
        share = sum(s == name for s in source.values()) / len(source)
        for v in by.values():
            assert abs(sum(source[r.doc_id] == name for r in v) - share * len(v)) <= 2
    for v in by.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
    again = sharding.shard(docs.repartition(7), 40, bucket_rows=10).collect()  # any layout, any buckets
    assert {r.doc_id: (r.shard, r.slot) for r in again} == {r.doc_id: (r.shard, r.slot) for r in rows}
    other = sharding.shard(docs, 40, seed=1).collect()
    assert {r.doc_id: r.shard for r in other} != {r.doc_id: r.shard for r in rows}


def test_few_repeated_and_no_rows(spark, make_docs):
    docs = make_docs(["a", "b", None])
    assert sorted(r.slot for r in sharding.shard(docs, 40).collect()) == [0, 0, 0]
    twice = docs.unionByName(docs).unionByName(docs)
    rows = sharding.shard(twice, 2, bucket_rows=1).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, i) for i in range(5)] + [(1, i) for i in range(4)]
    assert sharding.shard(make_docs([])).count() == 0


def test_many_small_sources_are_spread(spark):
    """A third of the rows come from sources of one row, another third is one row."""
    rows = [(i, f"s{i}" if i < 4_000 else "big", f"t{i}") for i in range(8_000)] + [(9_000, "big", "same")] * 4_000
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = sharding.shard(docs, 40, bucket_rows=100).collect()
    assert len(got) == 12_000 and {sum(r.shard == s for r in got) for s in range(40)} == {300}
    for s in range(40):
        here = [r for r in got if r.shard == s]
        assert abs(sum(r.source != "big" for r in here) - 100) <= 45
        assert abs(sum(r.doc_id == 9_000 for r in here) - 100) <= 45
        assert sorted(r.slot for r in here) == list(range(300))


def test_no_bucket_is_large(spark, monkeypatch):
    from pyspark.sql import DataFrame
    rows = [(i, f"s{i}", f"t{i}") for i in range(3_000)] + [(9_000, "big", "same")] * 3_000
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes, ranked = [], sharding._ranked

    def watch(df: DataFrame, group, key, order, buckets, out):
        at = df.selectExpr("*", f"least(floor({key} * {buckets}), {buckets - 1}) AS _x").groupBy(*group, "_x").count()
        sizes.append(at.agg({"count": "max"}).first()[0])
        return ranked(df, group, key, order, buckets, out)

    monkeypatch.setattr(sharding, "_ranked", watch)
    monkeypatch.setattr(sharding, "COPIES", 70)
    monkeypatch.setattr(sharding, "GROUP_BUCKETS", 7)
    got = sharding.shard(docs, 40, bucket_rows=100).collect()
    assert sorted(r.place for r in got) == list(range(6_000))
    assert len(sizes) == 2 and max(sizes) < 200
