"""Golden rows on small HTML pages."""

from pyspark.sql import functions as F

from pageloom.operators import extract as ex
from pageloom.operators.dom import node_table, parse_pages
from pageloom.operators.glossary import extract_glossary
from pageloom.operators.markdown import drop_promo_text
from pageloom.operators.rules import Site

URL = "https://www.example.org/guide/a/b/"
ARTICLE = """
<html><head><title>Pumps | Example</title></head><body>
<div class="flex_cell"><a href="#menu">Menu</a></div>
<div class="flex_cell"><h1>Pump Care Notes</h1><p>Oil the <strong>main bearing</strong> twice a year.</p>
<h2>In Winter</h2><p>Drain all water.</p><h2>In Summer</h2><p>Check the seal for dust.</p></div></body></html>"""


def page(spark, body, url=URL):
    html = body if "<html" in body else f"<html><body>{body}</body></html>"
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def article(spark, body, **kw):
    return ex.extract_articles(page(spark, body), Site(**kw)).first().asDict(recursive=True)


def test_article_page(spark):
    row = article(spark, ARTICLE)
    assert row["title"] == "Pump Care Notes"
    text = "# Pump Care Notes\n\nOil the **main bearing** twice a year.\n\n## In Winter\n\nDrain all water.\n\n## In Summer\n\nCheck the seal for dust."
    assert row["markdown_content"] == text
    assert (row["word_count"], row["char_count"]) == (len(text.split()), len(text))
    assert [(s["heading"], s["level"], s["content"]) for s in row["sections"]] == [
        ("In Winter", 2, "Drain all water."), ("In Summer", 2, "Check the seal for dust.")]
    assert row["key_concepts"][0] == "Pump Care Notes" and "main bearing" in row["key_concepts"]
    assert not any(row[k] for k in ("links", "images", "videos", "webinars", "related"))


def test_text_in_pieces_is_one_text(spark):
    row = article(spark, "<h1>A < B and C</h1><p>one </x> two</p><p>left<!-- note -->right &amp; on</p>")
    assert row["title"] == "A < B and C"
    assert "one  two" in row["markdown_content"] or "one two" in row["markdown_content"]
    nodes = {(n.tag, n.text) for n in node_table(parse_pages(page(spark, "<p>a < b</p><p>c<!-- - -->d</p>"))).collect()}
    assert {("#text", "a < b"), ("#text", "c"), ("#text", "d")} <= nodes


def test_pages_without_body_stay(spark):
    pages = spark.createDataFrame(
        [(1, URL, "<html><head><title>Only a head</title></head></html>"), (2, URL, "plain"), (3, URL, None), (4, URL, "")],
        "page_id long, url string, html string")
    rows = {r.page_id: r for r in ex.extract_articles(pages).collect()}
    assert rows[1].title == "Only a head" and rows[1].markdown_content == "" and rows[1].word_count == 0 and rows[1].sections == []
    assert sorted([*rows, *(r.page_id for r in ex.rejected_pages(pages).collect())]) == [1, 2, 3, 4]


def test_glossary_layouts(spark):
    def terms(body):
        return [(r.term, r.definition, r.acronym, r.strategy) for r in extract_glossary(page(spark, body)).orderBy("seq").collect()]

    assert terms("<div class='flex_cell'><h1>G</h1><dl><dt>One</dt><dd>First.</dd><dt>Two</dt><dd>Second.</dd></dl></div>") == [
        ("One", "First.", None, 2), ("Two", "Second.", None, 2)]
    assert terms("<table><tr><th>Term</th><th>Acronym</th><th>Definition</th></tr><tr><td>A</td><td></td><td>x</td></tr>"
                 "<tr><td>B</td><td>Bb</td><td>y</td></tr><tr><td>only</td></tr></table>") == [("A", "x", None, 1), ("B", "y", "Bb", 1)]
    assert terms("<table><tr><th>Term</th><th>Meaning</th></tr><tr><td>A</td><td>x</td></tr></table><h2>T</h2><p>d</p><p>e</p>") == [
        ("T", "d", None, 3)]
    assert terms("<p><strong>S</strong>: it <i>is</i> so</p><p>plain</p>") == [("S", "it  is  so", None, 4)]


def test_inline_markdown(spark):
    cases = {
        "<p> a <b> x </b> b </p>": "a **x** b",
        "<p>see <a href='/x'> <em>it</em> </a>.</p>": "see [*it*](/x).",
        "<p>e <a href='/x'></a> f</p>": "e  f",
        "<p>n <a>no</a></p>": "n no",
        "<p><a href='/x'><img src='i.png' alt='Alt' title='Ti'></a></p>": "[Ti](/x)",
        "<p>x<span></span> y <u> z</u></p>": "x y z",
        "<p>c <code> q </code> <img src='data:1' data-src='r.png' alt='R'></p>": "c ` q ` ![R](r.png)",
        "<ul><li>a<ul><li>in</li></ul></li><li> b</li></ul>": "- ain\n- b",
        "<pre>raw  text</pre>": "```\nraw  text\n```",
        "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>": "| 1 | 2 |\n| --- | --- |\n| 3 | 4 |",
        "<div><section><p>deep</p></section> loose </div><hr><h3> H <i>i</i></h3>": "deep\n\nloose\n\n### Hi",
        "<p>one <b>two<p>three": "one **two**\n\nthree",
    }
    rows = [(i, URL, f"<html><body>{b}</body></html>") for i, b in enumerate(cases)]
    df = ex.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r.markdown_content for r in df.collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_cleaning_and_call_to_action(spark):
    body = """<div class="flex_cell_inner">n</div><div class="flex_cell_inner"><p style="DISPLAY:  none">h</p><script>s</script>
    <div class="avia-button x">b</div><div class="avia-button-no">kept</div><a class="my-cta" href="/demo/">go</a>
    <p><a href="/demo/">plain</a></p><section><p>{}</p></section></div>"""
    promo = article(spark, body.format("Schedule a  demo"))
    assert promo["markdown_content"] == "kept\n\n[plain](/demo/)"
    assert article(spark, body.format("Related article: schedule a demo <a href='/pricing/'>P</a>"))["links"][-1]["text"] == "P"
    assert article(spark, body.format("fine <a href='/blog/x/demo/'>t</a>"))["markdown_content"].endswith("fine [t](/blog/x/demo/)")


def test_links(spark):
    row = article(spark, """<a href="../c/#f">rel</a><a href="/guide/ch/art/?q">in</a><a href="/guide/ch/">ov</a><a href="#x">no</a>
    <a href="javascript:1">no</a><a href="https://far.net/y"><img src="i" alt=" pic "></a><a href="//cdn.example.org/z">cdn</a><a href="?p=2">q</a>""")
    assert [(x["text"], x["url"], x["is_internal"], x["target_section_id"]) for x in row["links"]] == [
        ("rel", "https://www.example.org/guide/a/c/#f", True, "a/c"), ("in", "https://www.example.org/guide/ch/art/?q", True, "ch/art"),
        ("ov", "https://www.example.org/guide/ch/", True, "ch/overview"), ("pic", "https://far.net/y", False, None),
        ("cdn", "https://cdn.example.org/z", True, None), ("q", "https://www.example.org/guide/a/b/?p=2", True, "a/b")]


def test_media(spark):
    row = article(spark, """<h2>Pics</h2><img src="data:0"><noscript><img src="/n.png"></noscript><img src="/n.png" alt="again">
    <figure><img data-lazy-src="/l.png" src="data:1" title="L"><figcaption> Cap </figcaption></figure>
    <iframe src="https://www.youtube.com/watch?v=ab_1"></iframe><iframe src="https://youtu.be/ab_1"></iframe>""")
    assert [(i["url"], i["title"], i["caption"], i["context"]) for i in row["images"]] == [
        ("https://www.example.org/n.png", None, None, "Pics"), ("https://www.example.org/l.png", "L", "Cap", "Pics")]
    assert [v["video_id"] for v in row["videos"]] == ["ab_1"]


def test_related_kinds(spark):
    box = '<div class="x av_promobox">Related article <a href="{}">{}</a></div>'
    urls = [("/blog/p/", "b"), ("/guide/c/d/", "i"), ("https://resources.example.org/r", "r"), ("/else/", "e"), ("https://far.net/", "f"), ("/blog/p/", "dup")]
    row = article(spark, "".join(box.format(u, t) for u, t in urls))
    assert [(r["title"], r["source_type"]) for r in row["related"]] == [
        ("b", "blog"), ("i", "internal"), ("r", "resource"), ("e", "example"), ("f", "external")]


def test_sections_rules(spark):
    row = article(spark, """<p>before</p><h2>One</h2><p>a</p><ul><li>skipped</li></ul><p>b <a href="/x/">l</a></p><h3> </h3><p>swallowed</p>
    <h4>Last</h4><p>c <a href="/y/">m</a></p>""")
    assert [(s["heading"], s["level"], s["content"], [x["text"] for x in s["cross_references"]]) for s in row["sections"]] == [
        ("One", 2, "a\n\nb [l](/x/)", ["l"]), ("Last", 4, "c [m](/y/)", ["m"])]


def test_concepts_cap_and_rules(spark):
    bold = "".join(f"<b>term {i:02d}</b> " for i in range(30))
    row = article(spark, f"<h1>The New World Order</h1><p>{bold}</p><p>Scope Creep refers to growth.</p><em>the</em><em>ab</em>")
    assert row["key_concepts"] == ["Scope Creep", "The New World Order"] + [f"term {i:02d}" for i in range(18)]


def test_promo_text(spark):
    text = "a\n## Ready to find out more?\nx\n### Free trial\ny\n## Next\nb\nGet  started today!\nc"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.expr(drop_promo_text("t", Site()))).first()[0] == "a\n## Next\nb\nc"


def test_nodes_are_nested(spark):
    rows = node_table(parse_pages(page(spark, ARTICLE))).collect()
    by_id = {r.node_id: r for r in rows}
    for r in rows:
        assert r.end_id >= r.node_id
        if r.parent_id >= 0:
            up = by_id[r.parent_id]
            assert up.node_id < r.node_id and r.end_id <= up.end_id and r.path == f"{up.path}/{r.tag}"


def test_empty_page_is_rejected(spark):
    df = spark.createDataFrame([(1, URL, None), (2, URL, "")], "page_id long, url string, html string")
    assert ex.extract_articles(df).count() == 0 and ex.rejected_pages(df).count() == 2
