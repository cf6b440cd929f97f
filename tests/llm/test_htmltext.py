import time

from quarry.llm import htmltext, queries

PARA = "A paragraph of the article, long enough to be told from the short lines of menus and the like, {}."
BODY = "".join(f"<p>{PARA.format(i)}</p>" for i in range(4)) + "<p>End.</p>"
TEXT = " ".join(PARA.format(i) for i in range(4)) + " End."
NOISE = ("<p>Some words that stand beside the article and go on for as long as any paragraph of it does, "
         "so that length alone does not tell.</p>")
LINKS = "".join(f'<li><a href="/{i}">A link of the menu number {i}</a></li>' for i in range(9))


def test_pages_without_marks():
    main = htmltext.main_text
    head = "<html><head><title>T</title><style>p{}</style><script>var p='<p>no</p>'</script></head><body>"
    assert main(f"{head}<div><ul>{LINKS}</ul></div><div>{BODY}</div><div><div>Imprint</div></div>") == TEXT
    for beside in (f"<nav>{NOISE}</nav>", f"<aside>{NOISE}</aside>", f"<header>{NOISE}</header>",
                   f"<footer>{NOISE}</footer>", f"<form>{NOISE}</form>", f'<div class="side-bar sidebar">{NOISE}</div>',
                   f'<div id="cookieNotice">{NOISE}</div>', f'<section class="comments">{NOISE}</section>',
                   f'<div class="ad">{NOISE}</div>', f'<div role="alert">{NOISE}</div>',
                   f"<div><h3>2 Comments</h3>{NOISE}</div>", f"<noscript>{NOISE}</noscript>", f"<!-- {NOISE} -->"):
        assert main(f"{head}{beside}<div>{BODY}</div></body></html>") == TEXT, beside
        assert main(f"{head}<div>{BODY}</div>{beside}</body></html>") == TEXT, beside
        assert main(f"{head}<div>{BODY[:-11]}{beside}<p>End.</p></div></body></html>") == TEXT, beside


def test_marked_pages():
    main = htmltext.main_text
    for mark in ("<article>{}</article>", "<main>{}</main>", '<div role="main">{}</div>', "<main><article>{}</article></main>"):
        page = f"<body>{NOISE}" + mark.format(
            f'<p>Hi.</p>{BODY}<aside>{NOISE}</aside><form><label>Mail</label></form><p>Bye <b>n</b>ow.</p>'
            f'<div class="comments"><article>{NOISE}</article></div><footer>{NOISE}</footer>') + NOISE
        assert main(page) == f"Hi. {TEXT} Bye now.", mark
    assert main("<article><header><h1>Name</h1><p>By me</p></header><p>x</p></article>") == "Name x"
    assert main('<article><div class="post-header"><h1 class="header">Name</h1></div><p>x</p></article>') == "Name x"
    assert main(f'<body class="no-sidebar with-ads"><form><article>{BODY}</article></form>') == TEXT
    assert main(f'<article>{BODY}</article><article class="card"><a href=x>Other</a></article>') == TEXT
    assert main(f'<div class="widget">{BODY * 4}</div>') == " ".join([TEXT] * 4)
    assert main("<article></article><p>" + NOISE) == ""


def test_block_sums_decide_on_marked_pages(monkeypatch):
    """The sums run over all lines of a marked page, and a stretch of the mark is
    held to the same level as any other."""
    asked, own = [], htmltext.stretches
    monkeypatch.setattr(htmltext, "stretches", lambda *a, **kw: asked.append((a, kw)) or own(*a, **kw))
    page = f"<p>{PARA}</p><ul>{LINKS}</ul><article><h1>Name</h1>{BODY}</article><div>{NOISE}</div>"
    assert htmltext.main_text(page) == f"Name {TEXT}"
    (weights,), kw = asked.pop()
    inside = [len(t) for t in ("Name", *(PARA.format(i) for i in range(4)), "End.")]
    assert not kw and [w for w in weights if w] == inside and len(weights) >= 6 + 1 + 9 + 1
    first = next(i for i, w in enumerate(weights) if w)
    assert own(weights) == [(first, first + 5)]
    beside = "<article><p>Forty letters of some other short text.</p><p>And as many once more.</p></article>"
    far = f"<article><p>{PARA}</p><p>{PARA}</p></article><p>a</p><p>b</p><p>c</p>{beside}"
    assert htmltext.main_text(far) == f"{PARA} {PARA}"


def test_references_space_and_broken_markup():
    main = htmltext.main_text
    assert main("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x41; &nbsp;\t\n x&copy<br>y<p>un<i>clos</i>ed") == (
        "a <b> &amp; ééA x© y unclosed")
    assert main("<p>1 < 2 and <3, a<b c='>'>b</b>c</p>") == "1 < 2 and <3, abc"
    assert main("<article><h1>T<p><b>x<br><p>y</div></article>z") == "T x y"
    for empty in (None, "", " \n", "<p></p>", "<!-- x", "<script>x", "<a href=\"", "<p"):
        assert main(empty) == ""
    assert (main("plain text"), main("<")) == ("plain text", "<")


def test_surge_and_dive():
    assert htmltext.block_sums([5, 0, 0, 0, 7]) == [5, 5, 5, 0, 7, 7, 7]
    assert htmltext.stretches([0, 50, 60, 0, 0, 0, 9, 0, 0, 0, 100]) == [(1, 2), (10, 10)]
    assert htmltext.stretches([0, 5, 0, 0, 0, 3]) == [(1, 1), (5, 5)]
    assert htmltext.stretches([]) == htmltext.stretches([0, 0]) == []


def test_long_and_hostile_pages():
    start = time.time()
    for bad in ("<", "<a b=\"", "<!--", "<p>", "<b>", "</div>", "<div>", "&amp;", "<article>", "<a '", "<script>",
                '<span class="ad">', "<h2>Comments</h2>"):
        htmltext.main_text(bad * 50_000)
    assert htmltext.main_text(f"<article>{BODY * 5_000}</article>") == " ".join([TEXT] * 5_000)
    assert time.time() - start < 60


def test_query(spark, write_tables):
    rows = [(1, "u", f"<article>{BODY}</article>", "t"), (1, "u", f"<article>{BODY}</article>", "t"),
            (None, None, None, None), (2, "v", "", "t")]
    schema = "page_id long, url string, html string, text string"
    sf = write_tables(pages=spark.createDataFrame(rows, schema))
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in queries.op13_html_text(spark, sf).collect())
    assert got == [(0, None, "", 0), (1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, "v", "", 0)]
    found, name = htmltext.extract(spark.createDataFrame(rows, schema))
    assert name == "text_" and set(found.columns) == {"page_id", "url", "text", "text_"}
    assert htmltext.extract(spark.createDataFrame([], schema))[0].count() == 0
