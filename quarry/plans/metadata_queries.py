"""Registered JSON metadata queries (M1-M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import jsonb
from quarry.plans.registry import register
from quarry.sources.testdata import PARENT_SQL, parent_name


@register("metadata_merge", f"""
SELECT doc_id, json_object('lang', lang, 'source', source, 'n_chars', n_chars,
                           '__parent', {PARENT_SQL}, '__chunk_index', 0)::VARCHAR AS metadata
FROM documents""")
def metadata_merge(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    base = F.to_json(F.struct("lang", "source", F.lit("stale").alias("__parent"), "n_chars"))
    merged = jsonb.merge_metadata(base, {"__parent": parent_name(F.col("doc_id")),
                                         "__chunk_index": F.lit(0)})
    return d.select("doc_id", merged.alias("metadata"))


@register("metadata_json", """
SELECT doc_id, json_object('lang', lang, 'source', source, 'text', text, 'n_chars', n_chars)::VARCHAR AS metadata
FROM documents""")
def metadata_json(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.to_json(F.struct("lang", "source", "text", "n_chars")).alias("metadata"))


@register("metadata_json_whole", """
SELECT doc_id, json_object('lang', lang, 'text', text)::VARCHAR AS metadata FROM documents""")
def metadata_json_whole(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.to_json(F.struct("lang", "text")).alias("metadata"))


@register("json_field", "SELECT event_id, props->>'k' AS k FROM events")
def json_field(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select("event_id", jsonb.json_field(F.col("props"), "k").alias("k"))


@register("json_contains", """SELECT event_id FROM events WHERE json_contains(props, '{"k": 69}')""")
def json_contains(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.where(jsonb.json_contains(F.col("props"), {"k": 69})).select("event_id")


_LABELED_META_SQL = """
SELECT d.doc_id,
       CASE WHEN l.doc_id IS NULL THEN json_object('lang', d.lang, 'source', d.source)
            ELSE json_object('lang', d.lang, 'source', d.source,
                             'labels', json_object('quality', l.quality, 'toxic', l.toxic),
                             'flags', json_array(l.quality, l.toxic)) END::VARCHAR AS metadata
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def _labeled_meta(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    j = d.join(lab, "doc_id", "left")
    labels = F.when(lab.quality.isNotNull(), F.struct("quality", "toxic"))
    flags = F.when(lab.quality.isNotNull(), F.array("quality", "toxic"))
    return j.select("doc_id", F.to_json(F.struct("lang", "source", labels.alias("labels"),
                                                 flags.alias("flags"))).alias("metadata"))


@register("json_contains_nested", f"""
WITH m AS ({_LABELED_META_SQL})
SELECT doc_id FROM m WHERE json_contains(metadata, '{{"lang": "en", "labels": {{"quality": 1}}, "flags": [0]}}')""")
def json_contains_nested(spark, sf):
    m = _labeled_meta(spark, sf)
    f = {"lang": "en", "labels": {"quality": 1}, "flags": [0]}
    return m.where(jsonb.json_contains(F.col("metadata"), f)).select("doc_id")


@register("json_has_key", f"""
WITH m AS ({_LABELED_META_SQL})
SELECT doc_id, list_contains(json_keys(metadata), 'labels') AS has_labels FROM m""")
def json_has_key(spark, sf):
    m = _labeled_meta(spark, sf)
    return m.select("doc_id", jsonb.json_has_key(F.col("metadata"), "labels").alias("has_labels"))


@register("jsonb_text", f"""
SELECT doc_id, '{{"lang": ' || to_json(lang) || ', "source": ' || to_json(source) || ', "n_chars": '
       || CAST(n_chars AS VARCHAR) || ', "__parent": ' || to_json({PARENT_SQL}) || '}}' AS meta_text
FROM documents""")
def jsonb_text(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    m = F.to_json(F.struct(parent_name(F.col("doc_id")).alias("__parent"), "n_chars", "source", "lang"))
    return d.select("doc_id", jsonb.jsonb_text(m).alias("meta_text"))
