"""Table of contents: addresses, discovery of articles from overview pages, numbering, link targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.sql import each, keep, q, struct
from pageloom.functions.text import article_id
from pageloom.functions.urls import resolve_url
from pageloom.operators.dom import attr, having, joined_text, parse_pages
from pageloom.operators.keyed import first_per_key, number_per_key
from pageloom.operators.rules import Site


def with_urls(toc: DataFrame, site: Site = Site()) -> DataFrame:
    """Overview articles live at the chapter address, others one level below."""
    base = F.lit(site.base_url)
    overview = F.concat(base, F.lit("/"), F.col("chapter_slug"), F.lit("/"))
    return toc.withColumn(
        "url",
        F.when(F.col("article_number") == 0, overview).otherwise(F.concat(overview, F.col("article_slug"), F.lit("/"))),
    )


def discover(pages: DataFrame, site: Site = Site()) -> DataFrame:
    """``pages(page_id, url, html, chapter_slug)`` to the first link per chapter and article slug."""
    pattern = f"concat({q('\\Q' + site.guide_path)}, chapter_slug, {q('\\E/([^/]+)/?')})"

    def read(a):
        href = attr(a, "href")
        return struct(
            slug=f"regexp_extract({href}, {pattern}, 1)", title=joined_text("nodes", a),
            url=resolve_url(q(site.base_url), href),
        )

    found = keep(each(having("nodes", "a"), read), lambda x: f"{x}.slug <> ''")
    rows = parse_pages(pages).select("page_id", "chapter_slug", F.posexplode_outer(F.expr(found)).alias("seq", "x"))
    rows = rows.filter("seq is not null")
    rows = rows.select("page_id", "chapter_slug", "seq", "x.slug", "x.title", "x.url")
    return first_per_key(rows, ["chapter_slug", "slug"], ["page_id", "seq"])


def complete_toc(toc: DataFrame, discovered: DataFrame, bucket_size: int = 1000) -> DataFrame:
    """Replace the articles of chapters that list at most one by an overview plus the discovered ones,
    numbered in order of discovery; other chapters stay as they are."""
    size = toc.groupBy("chapter_number", "chapter_slug", "chapter_title").agg(F.count(F.lit(1)).alias("n"))
    found = discovered.join(size.filter("n <= 1").drop("n"), "chapter_slug")
    numbered = number_per_key(
        found, "chapter_slug", ["page_id", "seq"], F.floor(F.col("page_id") / bucket_size), "article_number"
    )
    columns = ["chapter_number", "chapter_slug", "chapter_title", "article_number", "article_title", "article_slug"]
    articles = numbered.select(
        "chapter_number", "chapter_slug", "chapter_title", "article_number",
        F.col("title").alias("article_title"), F.col("slug").alias("article_slug"),
    )
    replaced = articles.select("chapter_number", "chapter_slug", "chapter_title").distinct()
    overviews = replaced.select(
        "*", F.lit(0).alias("article_number"), F.lit("Overview").alias("article_title"), F.lit("").alias("article_slug")
    )
    kept = toc.select(*columns).join(replaced.select("chapter_slug"), "chapter_slug", "left_anti").select(*columns)
    return kept.unionByName(overviews.select(*columns)).unionByName(articles.select(*columns))


def resolve_links(links: DataFrame, toc: DataFrame) -> DataFrame:
    """Turn slug targets (``chapter/article`` or ``chapter/overview``) into article ids."""
    targets = toc.select(
        F.concat_ws(
            "/", "chapter_slug", F.when(F.col("article_number") == 0, "overview").otherwise(F.col("article_slug"))
        ).alias("target_section_id"),
        article_id(F.col("chapter_number"), F.col("article_number")).alias("target_article_id"),
    )
    return links.join(targets, "target_section_id", "left")


def internal_edges(links: DataFrame) -> DataFrame:
    return links.filter("is_internal")
