"""The whole guide in one call: pages and a table of contents to every table and export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.text import article_id, content_type
from pageloom.operators import graph as gr
from pageloom.operators import mentions as mn
from pageloom.operators import relations as rl
from pageloom.operators.chunks import ChunkParams, chunk_articles, chunk_stats, with_entity_ids, with_summary
from pageloom.operators.discover import with_urls
from pageloom.operators.extract import extract_articles
from pageloom.operators.glossary import enrich_glossary, extract_glossary
from pageloom.operators.rules import Site
from pageloom.operators.vectors import embed_chunks
from pageloom.sources import writers as wr
from pageloom.sources.enriched import write_enriched_guide

#: Columns of the tables that a run without names or glossary lacks.
GLOSSARY = "seq long, term string, acronym string, definition string"
_PLACE = "name string, source_text string, start_pos int, end_pos int, confidence double, alignment_status string, attributes map<string,string>, chapter_number int, article_number int, position int"
MENTIONS = f"article_id string, entity_id string, entity_type string, {_PLACE}"
ENTITIES = f"entity_id string, entity_type string, source_article_id string, {_PLACE}"
RELATIONS = (
    "relationship_id string, relationship_type string, source_entity_id string, target_entity_id string, source_text string, "
    "source_article_id string, chapter_number int, article_number int, position int, confidence double"
)


def export_graph(tables: dict[str, DataFrame], folder: str, compression: str | None = None) -> dict[str, str]:
    """Typed CSV per node and edge table; names are those of ``writers.HEADERS``. Files are plain unless a
    ``compression`` is named (as ``gzip``)."""
    return {name: wr.write_graph_csv(df, name, folder, compression) for name, df in tables.items()}


def export_chunks(chunks: DataFrame, folder: str, embeddings: DataFrame | None = None, compression: str | None = None) -> dict[str, str]:
    paths = {"chunks": wr.write_jsonl(wr.chunk_records(chunks), f"{folder}/chunks", compression)}
    if embeddings is not None:
        paths["embeddings"] = wr.write_jsonl(wr.embedding_records(embeddings), f"{folder}/embeddings", compression)
    return paths


def export_texts(
    tables: dict[str, DataFrame], chapters: DataFrame, enrichment: DataFrame | None, folder: str, title: str, publisher: str,
    scraped: str | None = None,
) -> None:
    """JSON, JSON lines, book and statements of the tables of ``build_guide``; tables that are not there count as empty."""
    spark = chapters.sparkSession

    def empty(ddl: str) -> DataFrame:
        return spark.createDataFrame([], ddl)

    articles, chunks = tables["articles"], tables["chunks"]
    glossary = tables.get("glossary", empty(GLOSSARY))
    if "glossary_enrichment" in tables:
        more = tables["glossary_enrichment"].select("seq", "related_terms", "related_chapters")
        glossary = glossary.join(more, "seq", "left")
    wr.write_guide_json(articles, chapters, glossary, {"title": title, "publisher": publisher}, f"{folder}/guide", totals=True)
    wr.write_jsonl(wr.jsonl_records(articles, chapters, glossary, title), f"{folder}/records")
    wr.write_lines(wr.book_lines(articles, chapters, glossary, title, publisher, scraped), f"{folder}/book")
    mentions, entities = tables.get("mentions", empty(MENTIONS)), tables.get("entities", empty(ENTITIES))
    found, merged = tables.get("found_relationships", empty(RELATIONS)), tables.get("relationships", empty(RELATIONS))
    nodes = gr.article_nodes(articles, articles.select("article_id", "summary").filter("summary is not null"))
    wr.write_lines(wr.graph_statements(chapters, nodes, entities, glossary, mentions, merged), f"{folder}/statements")
    wr.write_lines(wr.chunk_statements(chunks, tables.get("chunk_entities", empty("chunk_id string, source_article_id string, entity_id string, position int, end_pos int"))), f"{folder}/chunk_statements")
    write_enriched_guide(
        f"{folder}/enriched_guide", articles=articles, mentions=mentions, entities=entities, article_relationships=found,
        relationships=merged, glossary=tables.get("glossary_enrichment", glossary), enrichment=enrichment, extracted_at=scraped)


def build_guide(
    spark: SparkSession, pages: DataFrame, toc: DataFrame, folder: str, site: Site = Site(), gazetteer: DataFrame | None = None,
    relationships: Callable[[DataFrame], DataFrame] | None = None, glossary_pages: DataFrame | None = None,
    params: ChunkParams = ChunkParams(), enrichment: DataFrame | None = None, title: str = "The Guide", publisher: str = "",
    scraped: str | None = None,
) -> dict[str, DataFrame]:
    """Every stage is written under ``folder`` and read back, so later stages never recompute earlier
    ones and a lost executor costs its tasks only. ``relationships`` turns mentions into raw
    relationships (see ``resolve_relationships``). ``enrichment(article_id, summary, ..)`` holds model summaries;
    they reach chunks, nodes, records and the enriched guide. Entries of the table of contents without a page are
    the table ``missing_pages``. Exports: ``chunks``, ``embeddings``, ``graph/*``, ``guide`` and ``enriched_guide``
    (JSON), ``records`` (JSON lines), ``book`` (Markdown), ``statements`` and ``chunk_statements``."""

    def saved(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/tables/{name}")
        return spark.read.parquet(f"{folder}/tables/{name}")

    out: dict[str, DataFrame] = {}
    parsed = extract_articles(pages, site)
    listed = with_urls(toc, site).select("chapter_number", "article_number", "article_title", "url")
    out["missing_pages"] = saved("missing_pages", listed.join(parsed.select("url"), "url", "left_anti"))
    arts = listed.join(parsed, "url").withColumn("title", F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("article_title")))
    arts = arts.withColumn("article_id", article_id(F.col("chapter_number"), F.col("article_number"))).withColumn(
        "content_type", content_type(F.col("article_number"))).drop("article_title")
    out["articles"] = saved("articles", with_summary(arts, enrichment))
    if glossary_pages is not None:
        # Terms are numbered within their page; over all pages the number follows the sort by page and place.
        terms = extract_glossary(glossary_pages, site).orderBy("page_id", "seq").withColumn("seq", F.monotonically_increasing_id())
        out["glossary"] = saved("glossary", terms)
    out["chunks"] = saved("chunks", chunk_articles(out["articles"], out["articles"].select("article_id", "summary"), params))
    if gazetteer is None:
        out["chunks"] = out["chunks"].withColumns({"entity_ids": F.expr("cast(array() as array<string>)"), "entity_count": F.lit(0)})
    else:
        out["mentions"] = saved("mentions", mn.extract_mentions(out["articles"], gazetteer))
        out["entities"] = saved("entities", mn.merge_entities(out["mentions"]))
        out["chunk_entities"] = saved("chunk_entities", mn.link_mentions(out["chunks"], out["mentions"]))
        out["chunks"] = saved("chunks_linked", with_entity_ids(out["chunks"], out["chunk_entities"]))
        out["chunk_stats"] = chunk_stats(out["chunks"], out["chunk_entities"])
        if relationships is not None:
            found = rl.resolve_relationships(relationships(out["mentions"]), out["mentions"])
            out["found_relationships"] = saved("found_relationships", found)
            out["relationships"] = saved("relationships", rl.collect_relationships(out["found_relationships"]))
        if "glossary" in out:
            out["glossary_enrichment"] = saved("glossary_enrichment", enrich_glossary(out["glossary"], out["entities"]))
    out["embeddings"] = saved("embeddings", embed_chunks(out["chunks"]))
    chapters = with_urls(toc, site).filter("article_number = 0").select(
        "chapter_number", F.col("chapter_title").alias("title"), F.col("url").alias("overview_url"))
    summaries = out["articles"].select("article_id", "summary").filter("summary is not null")
    tables = {"nodes_chapters": gr.chapter_nodes(chapters), "nodes_articles": gr.article_nodes(out["articles"], summaries), "nodes_chunks": gr.chunk_nodes(out["chunks"]),
              "rels_contains": gr.contains_edges(out["articles"]), "rels_article_chunk": gr.article_chunk_edges(out["chunks"])}
    if "mentions" in out:
        tables |= {"nodes_entities": gr.entity_nodes(out["entities"]),
                   "rels_mentions": gr.mentions_edges(out["mentions"]), "rels_chunk_entity": gr.chunk_entity_edges(out["chunk_entities"])}
    if "relationships" in out:
        tables["rels_semantic"] = gr.semantic_edges(out["relationships"])
    if "glossary" in out:
        tables["nodes_glossary"] = gr.glossary_nodes(out["glossary"])
    export_chunks(out["chunks"], folder, out["embeddings"])
    export_graph(tables, f"{folder}/graph")
    export_texts(out, chapters, enrichment, folder, title, publisher, scraped)
    return out
