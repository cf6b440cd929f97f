"""Sources (S1-S10, S15) on the edge rows of FIXTURES §3."""

import os

from pyspark.sql import functions as F

from quarry.sources import files, html

PATHS = ["/r/a/x.PDF", "/r/a/y.txt", "/r/b .docx", "/r/Processado/z.pdf", "/r/c/Processado/d/e.pdf",
         "/r/f/same.pdf", "/r/g/same.pdf", "/r/h/img.JPeG"]


def test_inventory_and_routes(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    inv = {r.path for r in files.inventory(df, "/r").collect()}
    assert inv == {"/r/a/x.PDF", "/r/b .docx", "/r/f/same.pdf", "/r/g/same.pdf", "/r/h/img.JPeG"}
    r = {x.path: (x.route, x.norm) for x in df.select(
        "path", files.route(F.col("path"), "ocr").alias("route"),
        files.normalize_name(F.col("path")).alias("norm")).collect()}
    assert r["/r/h/img.JPeG"][0] == "image" and r["/r/b .docx"] == ("unstructured", "/r/b.docx")
    assert r["/r/a/x.PDF"][0] == "ocr"
    root_only = spark.createDataFrame([("/Processado/k.pdf",)], "path string")
    assert files.inventory(root_only, "/Processado").count() == 1   # the root itself is kept


def test_archive_names(spark):
    df = spark.createDataFrame([(p,) for p in ["/r/f/same.pdf", "/r/g/same.pdf", "/r/h/same.pdf",
                                               "/r/i/other.tar.gz"]], "path string")
    got = {r.path: r.target for r in files.archive_names(df, "/r/Processado").collect()}
    assert got == {"/r/f/same.pdf": "/r/Processado/same.pdf", "/r/g/same.pdf": "/r/Processado/same_1.pdf",
                   "/r/h/same.pdf": "/r/Processado/same_2.pdf", "/r/i/other.tar.gz": "/r/Processado/other.tar.gz"}


def test_binary_file_listing(spark, scratch):
    for rel in ["a/x.PDF", "a/y.txt", "Processado/z.pdf", "c/Processado/d/e.pdf", "f/same.pdf"]:
        p = os.path.join(scratch, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(b"%PDF-1.4")
    got = sorted(os.path.relpath(r.path, scratch) for r in files.list_files(spark, scratch).collect())
    assert got == ["a/x.PDF", "f/same.pdf"]


def test_cascade_edges(spark):
    L = lambda n: "x" * n
    rows = [(1, L(101), L(200), None, None, "last"), (2, L(100), L(101), None, None, "last"),
            (3, L(99), None, L(150), None, "last"), (4, L(10), L(20), L(30), L(101), "last"),
            (5, L(10), L(20), None, None, ""), (6, L(10), None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, p string, s string, t string, f string, last string")
    text, idx = html.cascade(F.col("p"), [F.col("s"), F.col("t"), F.col("f")], F.col("last"))
    got = {r.id: (r.i, r.t) for r in df.select("id", idx.alias("i"), text.alias("t")).collect()}
    assert got[1] == (0, L(101)) and got[2] == (1, L(101)) and got[3] == (2, L(150))
    assert got[4] == (3, L(101)) and got[5] == (4, "") and got[6] == (-1, L(10))


def test_gate_boundaries(spark):
    df = spark.createDataFrame([("x" * 99,), ("x" * 100,), ("  " + "x" * 100,), (None,)], "t string")
    assert [r[0] for r in df.select(html.text_gate(F.col("t"))).collect()] == ["error", "ok", "ok", "error"]


def test_html_extract(spark):
    page = ('<html lang="pt"><head><title>T &amp; U</title><script>var x="<p>";</script></head>'
            '<body><!-- c --><article><h1>Head</h1><p>One &lt;two&gt;</p><ul><li>i1</li></ul></article></body></html>')
    df = spark.createDataFrame([(page,)], "h string")
    r = df.select(html.html_to_text(F.col("h")).alias("t"), html.html_to_markdown(F.col("h")).alias("m"),
                  html.page_info(F.col("h"), F.lit("u")).alias("i")).first()
    assert "var x" not in r.t and "One <two>" in r.t and "T & U" in r.t
    assert "# Head" in r.m and "- i1" in r.m
    assert r.i.title == "T & U" and r.i.lang == "pt" and r.i.numpages == 1


def test_archive_names_never_collide(spark):
    paths = ["/r/a/x.pdf", "/r/b/x.pdf", "/r/c/x_1.pdf", "/r/d/x_1.pdf", "/r/e/x.pdf", "/r/f/y", "/r/g/y",
             "/r/h/x_3.pdf", "/r/i/x.pdf", "/r/j/x_07.pdf"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: r.target[3:] for r in files.archive_names(df, "/r").collect()}
    assert got == {"/r/a/x.pdf": "x.pdf", "/r/b/x.pdf": "x_2.pdf", "/r/c/x_1.pdf": "x_1.pdf",
                   "/r/d/x_1.pdf": "x_1_1.pdf", "/r/e/x.pdf": "x_4.pdf", "/r/f/y": "y", "/r/g/y": "y_1",
                   "/r/h/x_3.pdf": "x_3.pdf", "/r/i/x.pdf": "x_5.pdf", "/r/j/x_07.pdf": "x_07.pdf"}
    old = spark.createDataFrame([("x.pdf",), ("x_2.pdf",), ("y_2",), ("z",)], "name string")
    again = [r.target[3:] for r in files.archive_names(df, "/r", existing=old).collect()]
    assert len(set(again)) == len(paths) and not {"x.pdf", "x_2.pdf", "y_2", "z"} & set(again)
    assert {"x_4.pdf", "x_5.pdf", "x_6.pdf", "x_7.pdf", "y", "y_1"} <= set(again)


def test_all_articles_and_the_last_resort(spark):
    from quarry.sources import html as H
    page = "<article><p>one</p></article><div>skip</div><article>two</article>"
    df = spark.createDataFrame([(1, page), (2, "none"), (3, None)], "k int, html string")
    got = [r.t for r in df.select(H.article_text(F.col("html")).alias("t")).collect()]
    assert got[0].split() == ["one", "two"] and got[1] == ""
    fail = lambda d: d.select("k", F.lit(None).cast("string").alias("text"))
    first = lambda d: d.select("k", F.concat(F.lit("p"), F.col("k")).alias("text"))
    out = {r.k: (r.text, r.stage) for r in H.staged_cascade(df, "k", [first, fail]).collect()}
    assert out == {1: ("p1", -1), 2: ("p2", -1), 3: ("p3", -1)}
    out = {r.k: (r.text, r.stage) for r in H.staged_cascade(df, "k", [fail, first]).collect()}
    assert out == {1: ("p1", 1), 2: ("p2", 1), 3: ("p3", 1)}
