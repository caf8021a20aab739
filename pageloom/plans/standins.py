"""Guide tables derived from the given tables, so that every operator runs on whole, growing input.

A document is an article, its lines are sections, their long first words are the gazetteer, benchmark
passages are the glossary, and each document also becomes a full HTML page.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.functions.text import ENTITY_TYPES, RELATIONSHIP_TYPES, article_id, char_count, content_type, word_count
from pageloom.operators.chunks import ChunkParams
from pageloom.operators.mentions import extract_mentions
from pageloom.operators.rules import Site
from pageloom.session import spread
from pageloom.sources.readers import read_pages, table

SITE = Site()
PARAMS = ChunkParams(summary_max_tokens=300, section_min_tokens=50, window_threshold=200, window_size=64, window_overlap=8)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"), "page_id")


def _numbered(docs: DataFrame) -> DataFrame:
    chapter = (F.col("doc_id") % 15 + 1).cast("int")
    number = F.floor(F.col("doc_id") / 15).cast("int")
    title = F.coalesce(F.nullif(F.trim(F.regexp_extract("text", r"^[^.\n]*", 0)), F.lit("")), F.lit("Untitled"))
    return docs.select(
        "*", chapter.alias("chapter_number"), number.alias("article_number"), title.alias("title"),
        F.concat(F.lit("chapter-"), chapter.cast("string")).alias("chapter_slug"),
        F.when(number == 0, "").otherwise(F.concat(F.lit("article-"), number.cast("string"))).alias("article_slug"),
    )


def _url() -> Column:
    base = F.concat(F.lit(SITE.base_url + "/"), F.col("chapter_slug"), F.lit("/"))
    return F.when(F.col("article_number") == 0, base).otherwise(F.concat(base, F.col("article_slug"), F.lit("/")))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    sections = F.transform(
        F.split("text", "\n"),
        lambda p, i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias("heading"), F.lit(2).alias("level"), p.alias("content")),
    )
    return _numbered(documents(spark, sf)).select(
        article_id(F.col("chapter_number"), F.col("article_number")).alias("article_id"), "chapter_number", "article_number",
        "title", _url().alias("url"), content_type(F.col("article_number")).alias("content_type"),
        F.col("text").alias("markdown_content"), word_count(F.col("text")).alias("word_count"),
        char_count(F.col("text")).alias("char_count"), sections.alias("sections"),
    )


def enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """Model summaries exist for the English documents: their first paragraph."""
    docs = table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", "text")
    return _numbered(docs).select(
        article_id(F.col("chapter_number"), F.col("article_number")).alias("article_id"),
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("summary"),
    )


def chapters(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).filter("article_number = 0").select("chapter_number", "title", F.col("url").alias("overview_url"))


def toc(spark: SparkSession, sf: str) -> DataFrame:
    return _numbered(documents(spark, sf)).select(
        "chapter_number", "chapter_slug", F.concat(F.lit("Chapter "), F.col("chapter_number").cast("string")).alias("chapter_title"),
        "article_number", F.col("title").alias("article_title"), "article_slug",
    )


def glossary(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("seq"), F.regexp_extract("text", r"\p{L}+", 0).alias("term"), F.col("text").alias("definition")
    )


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of six letters or more that begins a line, so names grow with the documents."""
    lines = documents(spark, sf).select(F.explode_outer(F.split("text", "\n")).alias("line"))
    words = lines.select(F.lower(F.regexp_extract("line", r"^\P{L}*(\p{L}+)", 1)).alias("name"))
    names = words.filter(F.length("name") >= 6).distinct()
    types = F.array(*[F.lit(t) for t in ENTITY_TYPES])
    return names.select("name", F.get(types, F.length("name") % 10).alias("entity_type"))


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    return extract_mentions(articles(spark, sf), gazetteer(spark, sf), max_words=1)


def whole_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the documents, and the first two words of each line where one blank parts them."""
    docs = documents(spark, sf)
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("name"))
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    pairs = lines.select(F.lower(F.regexp_extract("line", r"^\P{L}*(\p{L}+ \p{L}+)", 1)).alias("name")).filter("name <> ''")
    types = F.array(*[F.lit(t) for t in ENTITY_TYPES])
    return words.union(pairs).distinct().select("name", F.get(types, F.length("name") % 10).alias("entity_type"))


def whole_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return extract_mentions(articles(spark, sf), whole_gazetteer(spark, sf))


def spelled(texts: list[str], pass_no: int) -> list[list[tuple[str, str, dict]]]:
    """A stand-in for a model: words of ten letters or more, in the first pass those of even length, then
    all; every third length comes back with a letter missing, and each answer begins with a text that is not there."""
    kinds = [*ENTITY_TYPES, "unheard_of"]
    answers = []
    for text in texts:
        words = [w for w in re.findall(r"[^\W\d_]{10,}", text) if pass_no > 1 or len(w) % 2 == 0]
        given = [w[:2] + w[3:] if len(w) % 3 == 0 else w for w in words]
        answers.append([("concept", "7531 9642 8", {"pass": [str(pass_no)]})] + [
            (kinds[len(w) % len(kinds)], g, {"pass": [str(pass_no)], "size": [str(len(w))]}) for w, g in zip(words, given)])
    return answers


def raw_relationships(found: DataFrame) -> DataFrame:
    """Neighbouring mentions at most 40 characters apart. Some classes are unknown, some targets are
    missing and some name nothing, as raw extractions do."""
    w = Window.partitionBy("article_id").orderBy("position")
    df = found.select(
        "article_id", "chapter_number", "article_number", "position", "source_text", "end_pos",
        F.lead("start_pos").over(w).alias("next_start"), F.lead("source_text").over(w).alias("next_text"),
    ).filter(F.col("next_start") - F.col("end_pos") <= 40)
    classes = F.array(*[F.lit(t.lower()) for t in RELATIONSHIP_TYPES], F.lit("unheard_of"))
    target = F.when(F.col("position") % 17 == 0, "").when(
        F.col("position") % 11 == 0, F.concat("next_text", F.lit(" x"))).otherwise(F.col("next_text"))
    return df.select(
        "article_id", "chapter_number", "article_number", "position",
        F.get(classes, F.length("source_text") % 13).alias("rel_class"), F.col("source_text").alias("source"),
        target.alias("target"), F.concat_ws(" ", "source_text", "next_text").alias("evidence"),
    )


def _html(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def guide_pages(spark: SparkSession, sf: str) -> DataFrame:
    """``(page_id, url, html, chapter_slug)``: each document as a themed page with media, callouts,
    lists, a table, hidden and promotional parts."""
    df = _numbered(documents(spark, sf))
    n = F.col("doc_id").cast("string")

    def put(*pieces) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    def neighbour(step: int) -> Column:
        k = (F.col("article_number") + step).cast("string")
        return put('<li><a href="/guide/', F.col("chapter_slug"), "/article-", k, '/">Article ', k, "</a></li>")

    paragraphs = F.array_join(
        F.transform(F.split("text", "\n"), lambda p, i: F.concat(
            F.lit("<h2>p"), i.cast("string"), F.lit("</h2><p>"), _html(p), F.lit("</p>"))), "")
    callout = put('<div class="av_promobox"><p>RELATED ARTICLE: <a href="https://www.example.org/blog/post-', n,
                  '/">Post ', n, "</a></p></div>")
    closing = F.when(
        F.col("doc_id") % 2 == 0, '<section><h2>Ready to Find Out More?</h2><p><a href="/trial/">Start</a></p></section>'
    ).otherwise('<section><p>RELATED ARTICLE <a href="/trial/">Trial notes</a></p></section>')
    html = put(
        "<!DOCTYPE html><html><head><title>", _html(F.col("title")), " | Example</title><style>p{margin:0}</style></head><body>",
        '<div class="flex_cell_inner"><ul>', neighbour(1), neighbour(2), "</ul></div>",
        '<div class="av flex_cell_inner"><h1>', _html(F.col("title")), "</h1>",
        '<script>var p = "<p>no</p>";</script><!-- note --><div style="display: none">hidden</div>',
        '<div class="avia-button big">Buy</div><p><a class="cta" href="/pricing/">Prices</a></p>', paragraphs,
        '<h3>Media</h3><figure><img src="data:x" data-src="/img/', n, '.png" alt="Plate ', n, '"><figcaption>Figure ', n,
        '</figcaption></figure><img src="../img/shared.png" alt="" title="Shared"><img src="../img/shared.png">',
        '<iframe src="https://www.youtube.com/embed/v', n, '" title="Talk ', n, '"></iframe>',
        '<iframe data-src="https://youtu.be/v', n, '"></iframe><iframe src="https://video.example.net/x"></iframe>',
        '<p>See <a href="', _url(), '">own page</a>, <a href="https://other.example.net/', n,
        '"> <b>far</b> away </a> and <a href="#x">skip</a>.</p>',
        '<div class="row"><div class="flex_column a"><div class="avia-image-container"><a href="https://resources.example.org/webinar/deep-dive-',
        n, '/"><img src="data:y" data-lazy-src="/thumb/', n, '.png"></a></div></div>',
        '<div class="flex_column b"><h3>In This Webinar: look ', n, "</h3></div></div>", callout, callout,
        "<ul><li>alpha <em>one</em></li><li>beta</li></ul><ol><li>first</li><li>second</li></ol>",
        '<blockquote>Quote<br>two</blockquote><pre><code class="language-sql">select ', n, "</code></pre>",
        "<table><thead><tr><th>K</th><th>V</th></tr></thead><tbody><tr><td>id</td><td>", n, "</td></tr></tbody></table>",
        closing, "</div></body></html>",
    )
    return df.select(F.col("doc_id").alias("page_id"), _url().alias("url"), html.alias("html"), "chapter_slug")


def glossary_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One glossary page per benchmark passage; the layout follows the passage number: table,
    definition list, headings, or strong terms."""
    g = glossary(spark, sf).select("seq", _html(F.col("term")).alias("t"), _html(F.col("definition")).alias("d"))

    def put(*pieces) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    t, d, n = F.col("t"), F.col("d"), F.col("seq").cast("string")
    body = (
        F.when(F.col("seq") % 4 == 0, put(
            "<table><tr class='heading-row'><th>Acronym</th><th>Term</th><th>Definition</th></tr><tr><td>A", n, "</td><td>", t,
            "</td><td>", d, "</td></tr><tr><td></td><td>second ", n, "</td><td>again</td></tr></table>"))
        .when(F.col("seq") % 4 == 1, put("<dl><dt>", t, "</dt><dd>", d, "</dd><dt>second ", n, "</dt><dd>again</dd></dl>"))
        .when(F.col("seq") % 4 == 2, put("<h2>", t, "</h2><p></p><p>", d, "</p><h3>second ", n, "</h3><p>again</p><p>more</p>"))
        .otherwise(put("<p><strong>", t, "</strong>: ", d, "</p><p><strong>second ", n, "</strong> - <i>again</i></p>"))
    )
    return g.select(
        F.col("seq").alias("page_id"), F.lit(SITE.base_url + "/glossary/").alias("url"),
        put("<html><body><div class='flex_cell'>", body, "</div></body></html>").alias("html"),
    )
