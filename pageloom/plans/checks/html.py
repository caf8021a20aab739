"""Page extraction over ``pages`` and over themed pages derived from ``documents`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions.text import article_id, char_count, content_type, word_count
from pageloom.operators import discover as di
from pageloom.operators import extract as ex
from pageloom.operators import markdown as md
from pageloom.operators.dom import node_table, parse_pages
from pageloom.operators.extract import columns
from pageloom.operators.glossary import extract_glossary
from pageloom.operators.rollups import chapter_rollup
from pageloom.plans import standins as st
from pageloom.plans.checks import register
from pageloom.plans.checks.ctes import sql
from pageloom.plans.checks.text import ints


def _decoded(x: str) -> str:
    """Character references that the pages use."""
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·")):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


_HOST = r"regexp_extract(url, '^[a-z]+://[^/]+')"
_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

#: Article text of a raw page, block by block, written from the markup.
_PAGE_TEXT = rf"""
SELECT page_id, url, title, '# ' || title || coalesce((SELECT string_agg(chr(10) || chr(10) || b, '' ORDER BY i) FROM (
    SELECT i, CASE WHEN contains(x, '<b>') THEN {_TRIM.format("split_part(x, '<b>', 1)")} || '**' || {_TRIM.format("replace(split_part(x, '<b>', 2), '<br>', chr(10))")} || '**'
      ELSE {_TRIM.format("replace(x, '<br>', chr(10))")} END AS b FROM (
      SELECT i, {_decoded("replace(ps[i], '</p>', '')")} AS x FROM (SELECT unnest(range(2, len(ps) + 1)) AS i))) WHERE trim(b) <> ''), '') AS md
FROM (SELECT page_id, url, {_TRIM.format(_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')"))} AS title,
  string_split(regexp_extract(html, '</h1>(.*)</article>', 1, 's'), '<p>') AS ps FROM pages)"""


@register("page_source", "SELECT page_id, url, length(html) AS chars FROM pages WHERE html IS NOT NULL")
def page_source(spark, sf):
    return st.read_pages(spark, sf).select("page_id", "url", F.length("html").cast("long").alias("chars"))


@register("rejected_pages", "SELECT page_id, url FROM pages WHERE (CASE WHEN page_id % 7 = 0 THEN NULL ELSE html END) IS NULL")
def rejected_pages(spark, sf):
    """Fetch failures are null HTML; every seventh page plays one."""
    failed = st.table(spark, sf, "pages").withColumn("html", F.when(F.col("page_id") % 7 != 0, F.col("html")))
    return ex.rejected_pages(failed)


@register("page_nodes", r"""
SELECT page_id, len(regexp_extract_all(html, '<(p|li|a|b|br|h1|ul|nav|div|article|footer)[ >]')) AS elements,
  len(regexp_extract_all(html, '<a ')) AS links, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages""")
def page_nodes(spark, sf):
    nodes = node_table(parse_pages(st.pages(spark, sf)))
    tags = ["p", "li", "a", "b", "br", "h1", "ul", "nav", "div", "article", "footer"]
    return nodes.groupBy("page_id").agg(
        F.count_if(F.col("tag").isin(tags)).alias("elements"), F.count_if(F.col("tag") == "a").alias("links"),
        F.count_if(F.col("tag") == "p").alias("paragraphs"))


@register("page_titles", f"SELECT page_id, {_TRIM.format(_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')"))} AS title FROM pages")
def page_titles(spark, sf):
    return columns(parse_pages(st.pages(spark, sf)), title=ex.title(st.SITE)).select("page_id", "title")


@register("page_links", rf"""
SELECT page_id, i - 1 AS seq, {_decoded("ts[i]")} AS text, {_HOST} || {_decoded("hs[i]")} AS url, true AS is_internal FROM (
  SELECT page_id, url, hs, ts, unnest(range(1, len(hs) + 1)) AS i FROM (
    SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS ts FROM pages))""")
def page_links(spark, sf):
    df = ex.extract_links(st.pages(spark, sf), st.SITE, whole_body=True)
    return ints(df.select("page_id", "seq", "text", "url", "is_internal"), "seq")


@register("internal_links", rf"""
SELECT page_id, sum(len(regexp_extract_all(html, '<a href="([^"]*)">([^<]+)</a>')))::BIGINT AS n FROM pages GROUP BY 1 HAVING n > 0""")
def internal_links(spark, sf):
    df = di.internal_edges(ex.extract_links(st.pages(spark, sf), st.SITE, whole_body=True))
    return df.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


@register("page_markdown", _PAGE_TEXT.replace("SELECT page_id, url, title, '# '", "SELECT page_id, '# '", 1))
def page_markdown(spark, sf):
    content = ex.with_content(parse_pages(st.pages(spark, sf)), st.SITE)
    return content.select("page_id", F.expr(md.root_markdown()).alias("md"))


@register("page_articles", f"""
SELECT page_id, title, len(regexp_extract_all(md, '\\S+')) AS word_count, length(md) AS char_count FROM ({_PAGE_TEXT})""".replace("\\\\", "\\"))
def page_articles(spark, sf):
    return ex.extract_articles(st.pages(spark, sf), st.SITE).select("page_id", "title", "word_count", "char_count")


@register("page_chapter_rollup", f"""
SELECT page_id % 15 + 1 AS chapter_number, count(*) AS article_count, sum(len(regexp_extract_all(md, '\\S+')))::BIGINT AS total_word_count
FROM ({_PAGE_TEXT}) GROUP BY 1""".replace("\\\\", "\\"))
def page_chapter_rollup(spark, sf):
    df = ex.with_content(parse_pages(st.pages(spark, sf)), st.SITE)
    df = df.select((F.col("page_id") % 15 + 1).alias("chapter_number"), F.expr(md.root_markdown()).alias("md"))
    return chapter_rollup(df.withColumn("word_count", word_count(F.col("md"))))


# ---- themed pages --------------------------------------------------------------------------------

_ROOT = "https://www.example.org"


@register("guide_titles", sql(r"SELECT doc_id AS page_id, regexp_replace(title, '^\s+|\s+$', '', 'g') AS title FROM doc", "doc"))
def guide_titles(spark, sf):
    """Without the h1, so that the title element and its suffix rule are used."""
    pages = st.guide_pages(spark, sf).withColumn("html", F.regexp_replace("html", "(?s)<h1>.*?</h1>", ""))
    return columns(parse_pages(pages), title=ex.title(st.SITE)).select("page_id", "title")


@register("guide_content_root", "SELECT doc_id AS page_id, 'div' AS tag, 'av flex_cell_inner' AS class FROM documents")
def guide_content_root(spark, sf):
    df = ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE)
    return df.select("page_id", "root.tag", F.col("root.attrs")["class"].alias("class"))


@register("guide_call_to_action", "SELECT doc_id AS page_id, doc_id % 2 = 0 AS removed FROM documents")
def guide_call_to_action(spark, sf):
    """Whether the closing section was taken out as a call to action."""
    df = ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE)
    return df.select("page_id", F.expr("not exists(body, n -> n.tag = 'section')").alias("removed"))


@register("guide_clean_text", "SELECT doc_id AS page_id, 0::BIGINT AS script, 0::BIGINT AS hidden, 0::BIGINT AS buttons, 0::BIGINT AS prices, length(text) > 0 AS has_text FROM documents")
def guide_clean_text(spark, sf):
    """What cleaning takes out leaves no trace in the body."""
    df = ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE)

    def hits(pattern):
        return F.expr(f"cast(size(filter(body, n -> n.text rlike '{pattern}')) as bigint)")

    return df.select("page_id", hits("^var p =").alias("script"), hits("^hidden$").alias("hidden"), hits("^Buy$").alias("buttons"),
                     hits("^Prices$").alias("prices"), F.expr("exists(body, n -> length(n.text) > 0)").alias("has_text"))


_LINKS = f"""
SELECT doc_id AS page_id, * EXCLUDE doc_id FROM (
  SELECT doc_id, 0 AS seq, 'own page' AS text, url, true AS is_internal, chapter_slug || '/' || CASE WHEN article_slug = '' THEN 'overview' ELSE article_slug END AS target_section_id FROM doc
  UNION ALL SELECT doc_id, 1, 'faraway', 'https://other.example.net/' || doc_id, false, NULL FROM doc
  UNION ALL SELECT doc_id, i + 2, 'Post ' || doc_id, '{_ROOT}/blog/post-' || doc_id || '/', true, NULL FROM doc, range(2) t(i)
  UNION ALL SELECT doc_id, 4, 'Trial notes', '{_ROOT}/trial/', true, NULL FROM doc WHERE doc_id % 2 = 1)"""


@register("guide_links", sql(_LINKS, "doc"))
def guide_links(spark, sf):
    df = ex.extract_links(st.guide_pages(spark, sf), st.SITE)
    return ints(df.select("page_id", "seq", "text", "url", "is_internal", "target_section_id"), "seq")


@register("resolve_links", sql("""
SELECT doc_id AS page_id, chapter_slug || '/' || CASE WHEN article_slug = '' THEN 'overview' ELSE article_slug END AS target_section_id, article_id AS target_article_id FROM doc""", "doc"))
def resolve_links(spark, sf):
    links = ex.extract_links(st.guide_pages(spark, sf), st.SITE).filter("target_section_id is not null")
    return di.resolve_links(links, st.toc(spark, sf)).select("page_id", "target_section_id", "target_article_id")


@register("guide_images", sql(f"""
SELECT doc_id AS page_id, 0 AS seq, '{_ROOT}/img/' || doc_id || '.png' AS url, 'Plate ' || doc_id AS alt_text, NULL AS title, 'Figure ' || doc_id AS caption, 'Media' AS context FROM doc
UNION ALL SELECT doc_id, 1, CASE WHEN article_number = 0 THEN '{_ROOT}/guide/img/shared.png' ELSE '{_ROOT}/guide/' || chapter_slug || '/img/shared.png' END, '', 'Shared', NULL, 'Media' FROM doc
UNION ALL SELECT doc_id, 2, '{_ROOT}/thumb/' || doc_id || '.png', '', NULL, NULL, 'Media' FROM doc""", "doc"))
def guide_images(spark, sf):
    df = columns(ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE), images=ex.images())
    return ints(ex.parts(df, "images"), "seq")


@register("guide_videos", """
SELECT doc_id AS page_id, 0 AS seq, 'https://www.youtube.com/watch?v=v' || doc_id AS url, 'https://www.youtube.com/embed/v' || doc_id AS embed_url, 'v' || doc_id AS video_id,
  'youtube' AS platform, 'Talk ' || doc_id AS title, 'Media' AS context FROM documents""")
def guide_videos(spark, sf):
    df = columns(ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE), videos=ex.videos())
    return ints(ex.parts(df, "videos"), "seq")


def _media(spark, sf):
    return ex.with_media(ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE), st.SITE)


@register("guide_webinars", f"""
SELECT doc_id AS page_id, 0 AS seq, 'https://resources.example.org/webinar/deep-dive-' || doc_id || '/' AS url, 'Deep Dive ' || doc_id AS title,
  'In This Webinar: look ' || doc_id AS description, '{_ROOT}/thumb/' || doc_id || '.png' AS thumbnail_url, 'Media' AS context FROM documents""")
def guide_webinars(spark, sf):
    return ints(ex.parts(_media(spark, sf), "webinars"), "seq")


@register("guide_webinar_descriptions", """
SELECT doc_id AS page_id, 'https://resources.example.org/webinar/deep-dive-' || doc_id || '/' AS url, 'In This Webinar: look ' || doc_id AS description FROM documents""")
def guide_webinar_descriptions(spark, sf):
    content = ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE)
    return ex.parts(columns(content, descriptions=ex.webinar_descriptions(st.SITE)), "descriptions").drop("seq")


@register("guide_webinar_links", """
SELECT doc_id AS page_id, '**\U0001f4f9 [Deep Dive ' || doc_id || '](https://resources.example.org/webinar/deep-dive-' || doc_id || '/)**' AS shown,
  '**[In This Webinar: look ' || doc_id || '](https://resources.example.org/webinar/deep-dive-' || doc_id || '/)**' AS announced FROM documents""")
def guide_webinar_links(spark, sf):
    """The two texts that replace thumbnail and announcement."""
    df = ex.with_webinar_links(_media(spark, sf))
    texts = F.expr("transform(filter(body, n -> n.tag = '#text' and n.text like '%**%[%](%'), n -> trim('\\n' from n.text))")
    return df.select("page_id", texts.alias("t")).select("page_id", F.col("t")[0].alias("shown"), F.col("t")[1].alias("announced"))


@register("guide_related", f"""
SELECT doc_id AS page_id, 0 AS seq, '{_ROOT}/blog/post-' || doc_id || '/' AS url, 'Post ' || doc_id AS title, 'blog' AS source_type FROM documents""")
def guide_related(spark, sf):
    return ints(ex.parts(_media(spark, sf), "related"), "seq")


_CLEAN = r"regexp_replace(p, '^\s+|\s+$', '', 'g')"
_OWN_LINES = "'See [own page](' || url || '), [**far** away](https://other.example.net/' || doc_id || ') and [skip](#x).'"
_CALLOUT = f"'RELATED ARTICLE: [Post ' || doc_id || ']({_ROOT}/blog/post-' || doc_id || '/)'"


@register("guide_sections", sql(rf"""
SELECT doc_id AS page_id, i AS seq, 'p' || i AS heading, 2 AS level, {_CLEAN} AS content, 0::BIGINT AS links FROM (
  SELECT doc_id, i, ps[i + 1] AS p FROM (SELECT doc_id, ps, unnest(range(len(ps))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ps FROM doc)))
UNION ALL SELECT doc_id, len(string_split(text, chr(10))), 'Media', 3,
  {_OWN_LINES} || chr(10) || chr(10) || {_CALLOUT} || chr(10) || chr(10) || {_CALLOUT} || CASE WHEN doc_id % 2 = 1 THEN chr(10) || chr(10) || 'RELATED ARTICLE [Trial notes](/trial/)' ELSE '' END,
  4 + doc_id % 2 FROM doc""", "doc"))
def guide_sections(spark, sf):
    df = ex.with_webinar_links(_media(spark, sf))
    df = columns(df, sections=ex.sections())
    df = ex.parts(df, "sections").withColumn("links", F.size("cross_references")).drop("cross_references")
    return ints(df, "seq", "level", "links")


_FIXED_BLOCKS = f"""chr(10) || chr(10) || '### Media' || chr(10) || chr(10) || 'Figure ' || doc_id || chr(10) || chr(10) || '![Shared](../img/shared.png)' || chr(10) || chr(10) || '![Image](../img/shared.png)'
  || chr(10) || chr(10) || '\U0001f3ac [Talk ' || doc_id || '](https://www.youtube.com/watch?v=v' || doc_id || ')' || chr(10) || chr(10) || '\U0001f3ac [YouTube Video](https://www.youtube.com/watch?v=v' || doc_id || ')'
  || chr(10) || chr(10) || {_OWN_LINES}
  || chr(10) || chr(10) || '**\U0001f4f9 [Deep Dive ' || doc_id || '](https://resources.example.org/webinar/deep-dive-' || doc_id || '/)**'
  || chr(10) || chr(10) || '**[In This Webinar: look ' || doc_id || '](https://resources.example.org/webinar/deep-dive-' || doc_id || '/)**'
  || chr(10) || chr(10) || {_CALLOUT} || chr(10) || chr(10) || {_CALLOUT}
  || chr(10) || chr(10) || '- alpha *one*' || chr(10) || '- beta' || chr(10) || chr(10) || '1. first' || chr(10) || '2. second'
  || chr(10) || chr(10) || '> Quote' || chr(10) || '> two' || chr(10) || chr(10) || '```sql' || chr(10) || 'select ' || doc_id || chr(10) || '```'
  || chr(10) || chr(10) || '| K | V |' || chr(10) || '| --- | --- |' || chr(10) || '| id | ' || doc_id || ' |'
  || CASE WHEN doc_id % 2 = 1 THEN chr(10) || chr(10) || 'RELATED ARTICLE [Trial notes](/trial/)' ELSE '' END"""


@register("guide_markdown", sql(rf"""
SELECT doc_id AS page_id, regexp_replace('# ' || regexp_replace(title, '^\s+|\s+$', '', 'g') || (SELECT string_agg(chr(10) || chr(10) || '## p' || (i - 1) || CASE WHEN {_CLEAN} = '' THEN '' ELSE chr(10) || chr(10) || {_CLEAN} END, '' ORDER BY i)
  FROM (SELECT i, ps[i] AS p FROM (SELECT string_split(text, chr(10)) AS ps, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i))) || {_FIXED_BLOCKS}, '\n\n\n+', chr(10) || chr(10), 'g') AS markdown FROM doc""", "doc"))
def guide_markdown(spark, sf):
    return ex.extract_articles(st.guide_pages(spark, sf), st.SITE).select("page_id", F.col("markdown_content").alias("markdown"))


@register("promo_text_filter", rf"""
SELECT doc_id, regexp_replace(regexp_replace(p1 || chr(10) || '## Next' || chr(10) || rest, '\n\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS kept FROM (
  SELECT doc_id, string_split(text, chr(10))[1] AS p1, array_to_string(string_split(text, chr(10))[3:], chr(10)) AS rest FROM documents)""")
def promo_text_filter(spark, sf):
    """The second line of every document sits below a promotional heading; a promotional line closes it."""
    lines = F.split("text", "\n")
    promoted = F.array_join(F.concat(
        F.slice(lines, 1, 1), F.array(F.lit("## Ready to find out more?")), F.slice(lines, 2, 1),
        F.array(F.lit("### Free trial pricing"), F.lit("inside"), F.lit("## Next")),
        F.when(F.size(lines) > 2, F.slice(lines, 3, F.size(lines))).otherwise(F.array(F.lit(""))),
        F.array(F.lit("Please book  a demo today"))), "\n")
    df = st.documents(spark, sf).select("doc_id", promoted.alias("markdown"))
    return df.select("doc_id", F.expr(md.drop_promo_text("markdown", st.SITE)).alias("kept"))


_STOP = ", ".join(f"'{w}'" for w in ex.rules.STOP_WORDS)
_ASCII = r"regexp_replace(regexp_replace({}, '[^\x00-\x7F\p{{L}}\p{{N}}]', ' ', 'g'), '[^\x00-\x7F]', '_', 'g')"


@register("key_concepts", sql(rf"""
SELECT page_id, coalesce(string_agg(c, '|' ORDER BY c), '') AS concepts FROM (
  SELECT page_id, c, row_number() OVER (PARTITION BY page_id ORDER BY c) AS r FROM (SELECT DISTINCT page_id, c FROM (
    SELECT page_id, unnest(regexp_extract_all({_ASCII.format("title")}, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b')) AS c FROM (SELECT doc_id AS page_id, title FROM doc)
    UNION ALL SELECT doc_id, unnest(['far', 'one']) FROM doc
    UNION ALL SELECT doc_id, trim(regexp_extract({_CLEAN}, '^([A-Z][a-zA-Z\s]+?)\s+(?:is|are|refers?\s+to|means?)\s+', 1)) FROM (SELECT doc_id, unnest(string_split(text, chr(10)) || [title]) AS p FROM doc))
  WHERE c <> '' AND lower(c) NOT IN ({_STOP}) AND length(c) > 2 AND length(c) < 50
  UNION SELECT DISTINCT doc_id, c FROM (SELECT doc_id, trim(regexp_extract({_CLEAN}, '^([A-Z][a-zA-Z\s]+?)\s+(?:is|are|refers?\s+to|means?)\s+', 1)) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10)) || [title]) AS p FROM doc)) WHERE c <> '' AND length(c) < 50
  UNION SELECT DISTINCT doc_id, c FROM (SELECT doc_id, unnest(regexp_extract_all({_ASCII.format("title")}, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b')) AS c FROM doc) WHERE lower(c) NOT IN ({_STOP}) AND length(c) > 2)) WHERE r <= 20 GROUP BY 1""", "doc"))
def key_concepts(spark, sf):
    """Title phrases, emphasised terms and defined terms; the first twenty in code-point order."""
    df = columns(ex.with_content(parse_pages(st.guide_pages(spark, sf)), st.SITE), concepts=ex.key_concepts())
    return df.select("page_id", F.array_join("concepts", "|").alias("concepts"))


@register("discover_articles", f"""
SELECT chapter_slug, slug, 'Article ' || substr(slug, 9) AS title, '{_ROOT}/guide/' || chapter_slug || '/' || slug || '/' AS url FROM (
  SELECT DISTINCT 'chapter-' || (doc_id % 15 + 1) AS chapter_slug, 'article-' || (doc_id // 15 + s) AS slug FROM documents, (SELECT unnest([1, 2]) AS s))""")
def discover_articles(spark, sf):
    df = st.guide_pages(spark, sf).withColumn("html", F.regexp_replace("html", r'<p>See <a href="[^"]*">', "<p>See <a>"))
    return di.discover(df, st.SITE).select("chapter_slug", "slug", "title", "url")


@register("complete_toc", sql("""
SELECT chapter_number, chapter_slug, article_number, title AS article_title, article_slug FROM doc WHERE chapter_number > 5
UNION ALL SELECT DISTINCT chapter_number, chapter_slug, 0, 'Overview', '' FROM doc WHERE chapter_number <= 5
UNION ALL SELECT chapter_number, chapter_slug, row_number() OVER (PARTITION BY chapter_slug ORDER BY n), 'Article ' || n, 'article-' || n FROM (
  SELECT DISTINCT chapter_number, chapter_slug, article_number + s AS n FROM doc, (SELECT unnest([1, 2]) AS s) WHERE chapter_number <= 5)""", "doc"))
def complete_toc(spark, sf):
    """Five chapters list their overview only; their articles come from the pages' links."""
    toc = st.toc(spark, sf).filter("chapter_number > 5 or article_number = 0")
    pages = st.guide_pages(spark, sf).withColumn("html", F.regexp_replace("html", r'<p>See <a href="[^"]*">', "<p>See <a>"))
    df = di.complete_toc(toc, di.discover(pages, st.SITE), bucket_size=100)
    return ints(df.select("chapter_number", "chapter_slug", "article_number", "article_title", "article_slug"), "article_number")


@register("assemble_articles", sql(r"""
SELECT article_id, chapter_number, article_number, regexp_replace(title, '^\s+|\s+$', '', 'g') AS title, CASE WHEN article_number = 0 THEN 'chapter_overview' ELSE 'article' END AS content_type FROM doc""", "doc"))
def assemble_articles(spark, sf):
    """Pages joined to the table of contents by address."""
    toc = di.with_urls(st.toc(spark, sf), st.SITE)
    parsed = columns(parse_pages(st.guide_pages(spark, sf).drop("chapter_slug")), title=ex.title(st.SITE)).select("url", "title")
    df = toc.join(parsed, "url")
    return df.select(
        article_id(F.col("chapter_number"), F.col("article_number")).alias("article_id"), "chapter_number", "article_number",
        F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("article_title")).alias("title"),
        content_type(F.col("article_number")).alias("content_type"))


@register("extract_glossary", r"""
SELECT item_id AS page_id, 0 AS seq, term, CASE WHEN item_id % 4 = 0 THEN 'A' || item_id END AS acronym, d AS definition, item_id % 4 + 1 AS strategy FROM (
  SELECT item_id, regexp_extract(text, '\p{L}+') AS term, regexp_replace(text, '^\s+|\s+$', '', 'g') AS d FROM benchmark)
UNION ALL SELECT item_id, 1, 'second ' || item_id, NULL, 'again', item_id % 4 + 1 FROM benchmark""")
def glossary_terms(spark, sf):
    return ints(extract_glossary(st.glossary_pages(spark, sf), st.SITE), "seq", "strategy")
