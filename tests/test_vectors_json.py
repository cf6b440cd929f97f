"""Vectors (V2-V6) and JSON metadata (M1-M6) on the edge rows of FIXTURES §3."""

import json
import math

import pytest
from pyspark.sql import functions as F

from quarry.functions import jsonb
from quarry.functions import vectors as vec

Q = [1.0, 0.0, 0.0]
VECS = [(1, [0.0, 0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0, 0.0, 5.0]), (4, [-1.0, 0.0, 0.0]),
        (5, [0.0, 1.0, 0.0]), (6, [1.0, 0.0, 0.0]), (7, [2.0, 0.0, 0.0])]


def test_fit_and_distances(spark):
    df = spark.createDataFrame(VECS, "id int, v array<float>")
    fitted = df.select("id", vec.fit_dim(F.col("v"), 3).alias("v"))
    rows = {r.id: r for r in fitted.select(
        "id", "v", vec.cosine_distance(F.col("v"), Q).alias("cd"),
        vec.neg_inner_product(F.col("v"), Q).alias("ip")).collect()}
    assert rows[2].v == [1.0, 0.0, 0.0] and rows[3].v == [1.0, 0.0, 0.0]
    assert math.isnan(rows[1].cd)                  # zero vector: NaN, no error
    assert rows[4].cd == pytest.approx(2.0) and rows[5].cd == pytest.approx(1.0)
    assert rows[6].cd == pytest.approx(0.0) and rows[7].cd == pytest.approx(0.0)  # ties
    assert rows[7].ip == pytest.approx(-2.0)


def test_zero_fallback(spark):
    df = spark.createDataFrame([(None,), ([1.0],)], "v array<float>")
    got = [r[0] for r in df.select(vec.zero_fallback(F.col("v"), 2)).collect()]
    assert got == [[0.0, 0.0], [1.0]]


META = [
    (1, '{"a": {"b": 1, "c": [1, 2, {"d": "x"}]}, "t": "1", "n": 1, "z": null, "e": "é"}'),
    (2, '{}'),
    (3, '{"t": 1, "n": "1"}'),
    (4, '[1, 2]'),
]


def brute_contains(a, b, top=True):
    if isinstance(b, dict):
        return isinstance(a, dict) and all(k in a and brute_contains(a[k], v, False) for k, v in b.items())
    if isinstance(b, list):
        return isinstance(a, list) and all(any(brute_contains(x, y, False) for x in a) for y in b)
    if isinstance(a, list) and top:
        return any(brute_contains(x, b, False) for x in a)
    if isinstance(b, bool) or isinstance(a, bool):
        return type(a) is type(b) and a == b
    if isinstance(b, (int, float)):
        return isinstance(a, (int, float)) and float(a) == float(b)
    return a == b


@pytest.mark.parametrize("f", [
    {}, {"a": {"b": 1}}, {"a": {"c": [2]}}, {"a": {"c": [{"d": "x"}]}}, {"t": "1"}, {"t": 1},
    {"n": 1}, {"n": 1.0}, {"z": None}, {"missing": 1}, {"e": "é"}, {"a": {"c": [3]}},
])
def test_containment_matches_brute_force(spark, f):
    df = spark.createDataFrame(META, "id int, m string")
    got = {r.id for r in df.where(jsonb.json_contains(F.col("m"), f)).collect()}
    want = {i for i, m in META if isinstance(json.loads(m), dict) and brute_contains(json.loads(m), f)}
    assert got == want


def test_has_key_field_merge(spark):
    df = spark.createDataFrame(META[:3], "id int, m string")
    got = {r.id: (r.hz, r.t) for r in df.select(
        "id", jsonb.json_has_key(F.col("m"), "z").alias("hz"),
        jsonb.json_field(F.col("m"), "t").alias("t")).collect()}
    assert got == {1: (True, "1"), 2: (False, None), 3: (False, "1")}
    base = '{"x": 1, "__parent": "old", "é": "ü"}'
    m = spark.createDataFrame([(base,)], "m string").select(
        jsonb.merge_metadata(F.col("m"), {"__parent": F.lit("new.pdf"), "__chunk_index": F.lit(2)})).first()[0]
    assert json.loads(m) == {"x": 1, "é": "ü", "__parent": "new.pdf", "__chunk_index": 2}
    assert "é" in m  # non-ASCII kept


def test_jsonb_key_order(spark):
    t = spark.createDataFrame([('{"bbb": 1, "a": "x", "cc": [1]}',)], "m string").select(
        jsonb.jsonb_text(F.col("m"))).first()[0]
    assert t.index('"a"') < t.index('"cc"') < t.index('"bbb"')


def test_containment_of_large_integers_and_any_key(spark):
    from quarry.functions import jsonb
    rows = [(1, '{"id": 9007199254740993}'), (2, '{"id": 9007199254740992}'), (3, '{"id": 9007199254740992.0}'),
            (4, '{"it\'s": "x", "a\\"b": {"c]": 1}}'), (5, '{"n": 1.5, "m": 2}'), (6, "not json")]
    df = spark.createDataFrame(rows, "k int, m string")

    def hits(f):
        return sorted(r.k for r in df.where(jsonb.json_contains(F.col("m"), f)).collect())
    assert hits({"id": 9007199254740993}) == [1]
    assert hits({"id": 9007199254740992}) == [2, 3]
    assert hits({"it's": "x"}) == [4] and hits({"it's": "y"}) == []
    assert hits({'a"b': {"c]": 1}}) == [4]
    assert hits({"n": 1.5}) == [5] and hits({"m": 2}) == [5] and hits({"n": 1}) == []


def test_rows_without_hot_keys_are_found(spark):
    from quarry.functions import jsonb
    rows = [(1, '{"title": "a"}', None), (2, '{"title": "a"}', ("a",)), (3, '{"title": "b"}', ("b",))]
    df = spark.createDataFrame(rows, "k int, metadata string, meta_hot struct<title:string>")
    assert sorted(r.k for r in df.where(jsonb.metadata_filter(df, {"title": "a"})).collect()) == [1, 2]
