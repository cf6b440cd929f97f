import base64
import gzip
import hashlib

import pytest

from quarry.llm import queries, warc

PAGES = "page_id long, url string, html string"


def rows():
    out = [(i, f"http://h{i % 7}.Example.com:80/p?x={i % 50}#f", f"<p>{i % 30} é</p>") for i in range(300)]
    out += [(1000 + i, "http://one.example.com/", "same page") for i in range(120)]
    return out + [(2000, None, None), (2001, "not a url", ""), (2002, "http://h/ a\r\nb", "x" * 300_000),
                  (2003, "https://u:p@a.b.org", None), (2004, "http://a.b.org/?q\tz", "é\r\n\r\nHTTP")]


def expect(pages):
    newest = {}
    for p, _, h in pages:
        if p is not None:
            newest[h or ""] = max(p, newest.get(h or "", p))
    out = []
    for p, _, h in pages:
        data, first = (h or "").encode(), newest.get(h or "")
        revisit = first is not None and p != first
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def digest(found):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in found), key=str)


def test_round_trip(spark, write_tables):
    sf = write_tables(pages=spark.createDataFrame(rows(), PAGES).repartition(4))
    assert digest(queries.op3_warc_index(spark, sf).collect()) == expect(rows())


@pytest.mark.parametrize("part_keys,block_lines", [(50, 4), (10_000, 1)])
def test_lookup_reads_only_what_is_asked_for(spark, scratch, part_keys, block_lines):
    pages = spark.createDataFrame(rows(), PAGES).selectExpr("*", "1 AS key", "2 AS sha1").repartition(3)
    captures = warc.write_archives(pages, f"{scratch}/a")
    parts = warc.write_index(captures, f"{scratch}/i", part_keys, block_lines)
    assert captures.count() == len(rows()) and parts.count() >= (5 if part_keys == 50 else 1)
    some = pages.where("page_id % 3 = 0")
    absent = spark.createDataFrame([("a,b)/ 1",), ("~",), ("",)], "key string")
    keys = warc.page_keys(some).unionByName(absent)
    found = warc.read_records(warc.lookup(keys.unionByName(keys), parts, f"{scratch}/i"), f"{scratch}/a")
    want = [x for x in expect(rows()) if x[0] % 3 == 0]
    assert digest(found.collect()) == want
    html = {p: (h or "").encode() for p, _, h in rows()}
    for r in found.where("record_type = 'response'").collect():
        assert bytes(r.payload) == html[r.page_id]


def test_repeated_rows_null_ids_and_empty_table(spark):
    data = [(1, "http://a/", "x"), (1, "http://a/", "x"), (None, "http://a/", "x"), (None, "http://b/", "y"),
            (None, "http://b/", "y")]
    pages = spark.createDataFrame(data, PAGES)
    assert digest(warc.round_trip(pages).collect()) == expect(data)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_records_are_gzip_members(spark, scratch):
    pages = spark.createDataFrame(rows()[:5], PAGES).coalesce(1)
    row = warc.write_archives(pages, f"{scratch}/a").orderBy("offset").collect()
    with open(f"{scratch}/a/{row[0].file}", "rb") as f:
        data = f.read()
    assert sum(r.length for r in row) == len(data)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 5


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com/A?b=1#c", "com,example,www)/A?b=1"), ("https://u:p@a.org:8080", "org,a:8080)/"),
    (None, "-"), ("", "-"), ("plain text", "plain%20text"), ("http://a.org/x y", "org,a)/x%20y")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key
