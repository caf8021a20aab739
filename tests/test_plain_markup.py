import random
import re

from pageloom.functions.sql import strip
from pageloom.operators.dom import _NodeLister, parse_pages, span
from pageloom.operators.rules import Site

PIECES = """<p>|</p>|<div class="a b">|</div>|text |a & b|&amp;|x < y|<br>|<BR>|<br/>|<script>|</script>|<script>var a="<p>x</p>";</script>
<style>p{}</style>|<title>|</title>|<title>A &amp; B</title>|<iframe src="u">|</iframe>|<!-- c -->|<!---->|<!-- a--b -->|<!DOCTYPE html>|<xmp>
<a href="?a=1&amp;b=2">|<a href="?a=1&b=2">|<a href='x'>|<img src="s" alt="t">|<li>|<ul>|<table><tr><td>|<b>|</b>|</x>|<p|<|"|&#39;|<html>|<head>|<body>
</body>|<textarea>|</textarea>|<plaintext>|<a A="1" a="2">|<svg:x y="1">|<script>a<!--b</script>|</SCRIPT>|<Script>q</Script>|</style >"""


def by_parser(html):
    lister = _NodeLister()
    lister._read_plain = lambda _: False
    return lister.list_nodes(html)


def test_both_ways_of_reading_agree():
    rng = random.Random(7)
    pieces, plain = [x for line in PIECES.split("\n") for x in line.split("|")], 0
    for _ in range(4000):
        html = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        plain += _NodeLister()._read_plain(html)
        assert _NodeLister().list_nodes(html) == by_parser(html), html
    assert 500 < plain < 3500


def test_plain_pages_are_not_parsed_mark_by_mark(monkeypatch):
    fed = []
    monkeypatch.setattr(_NodeLister, "feed", lambda self, html: fed.append(html))
    html = '<!DOCTYPE html><html><head><style>p{}</style></head><body><!-- c --><p class="x">a &amp; b<br><a href="?a&amp;b">c</a></p></body></html>'
    assert [row[3] for row in _NodeLister().list_nodes(html)][-6:] == ["body", "p", "#text", "br", "a", "#text"] and not fed
    _NodeLister().list_nodes(html.replace('"x"', "x"))
    assert len(fed) == 1


def test_strip_takes_all_white_space(spark):
    white = re.sub(r"\S", "", "".join(map(chr, [*range(0x80), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF])))
    texts = [None, "", " ", white, *(f"{c}a{c}b{c}{c}" for c in map(chr, [*range(0x100), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF]))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = r"'(?U)^\\s+|\\s+\\z'"
    assert df.where(f"not ({strip('t')} <=> regexp_replace(t, {pattern}, ''))").count() == 0
    assert "regexp" not in strip("t")


def test_span_is_a_slice(spark):
    df = spark.range(6).selectExpr("cast(id as int) as a", "array(1, 2, null, 4) as xs").crossJoin(
        spark.range(6).selectExpr("cast(if(id = 5, null, id) as int) as b")).where("a < 5 and coalesce(b, 0) <= 4")
    assert df.where(f"not ({span('xs', 'a', 'b')} <=> slice(xs, a + 1, greatest(b - a, 0 * b)))").count() == 0


def test_promotional_phrases(spark):
    lines = ["Please BOOK  a demo", "a free 30-day trial", "ready to find out more", "learn more about example", "Schedule a demo",
             "booka demo", "REQUEST A DEMO", "contact us  today", "Get started today", "ſchedule a demo", "booK a demo", "nothing", ""]
    plain = re.sub(r"^(\(\?iU\))\(\?=\[\w+\]\)", r"\1", Site().promo_text)
    df = spark.createDataFrame([(t,) for t in lines], "t string").selectExpr("t rlike r'%s' as a" % Site().promo_text, "t rlike r'%s' as b" % plain)
    rows = df.collect()
    assert [r.a for r in rows] == [r.b for r in rows] and sum(r.a for r in rows) == 10


def test_computed_pages_are_made_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "b"), (5, "c")], "k int, t string")
    pages = rows.selectExpr("k", "if(t = '', '', concat('<p>made', t, '</p>')) as html")
    parsed = parse_pages(pages)
    assert sorted(r.k for r in parsed.select("k").collect()) == [1, 4, 5]
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("<p>made") == 1
    assert parse_pages(pages.where("k in (2, 3)")).collect() == []
