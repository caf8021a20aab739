"""Whole outputs of the writers: every line, and every file written, read back and counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import graph as gr
from pageloom.operators import relations as rl
from pageloom.operators.chunks import with_entity_ids
from pageloom.operators.glossary import enrich_glossary
from pageloom.operators.mentions import link_mentions, merge_entities
from pageloom.operators.vectors import embed_chunks
from pageloom.plans import standins as st
from pageloom.plans.checks import ORACLES, register
from pageloom.plans.checks.ctes import sql
from pageloom.plans.checks.files import _ESC, BOOK_SQL, CHUNK_SQL, GRAPH_SQL, TITLE, folder
from pageloom.plans.checks.text import chunks
from pageloom.plans.guide import export_chunks, export_graph
from pageloom.session import dealt, written
from pageloom.sources.enriched import read_enriched_guide, write_enriched_guide
from pageloom.sources import readers as rd
from pageloom.sources import writers as wr


# The constraint, index and heading lines below are those of the file format.
def _fixed(k1: int, *lines: str) -> str:
    """Lines that are the same in every output; ``=`` alone stands for the rule."""
    texts = ["'// ' || repeat('=', 65)" if t == "=" else "'" + t.replace("'", "''") + "'" for t in lines]
    return f"\nUNION ALL SELECT {k1}, unnest([{', '.join(texts)}])"


@register("book_lines", BOOK_SQL + """
UNION ALL SELECT 0, 0, unnest(['# The Guide', '', '*Published by Example*', '*Scraped on 2024-02-29*', '', '---', '', '## Table of Contents', ''])""")
def book_lines(spark, sf):
    """Every line, with a given date."""
    lines = wr.book_lines(st.articles(spark, sf), st.chapters(spark, sf), st.glossary(spark, sf), TITLE, "Example", "2024-02-29")
    return lines.select("k1", "k2", "line")


@register("graph_statements", GRAPH_SQL + f"""
UNION ALL SELECT 21, 'CREATE (:Article {{article_id: ''' || article_id || ''', title: ''' || {_ESC.format("title")} || ''', url: ''' || url || ''', summary: '''
  || CASE WHEN lang = 'en' THEN {_ESC.format("left(string_split(text, chr(10))[1], 500)")} ELSE '' END || ''', word_count: ' || word_count || ', chapter_number: ' || chapter_number || '}});' FROM doc"""
    + _fixed(0, "=", "// CONSTRAINTS", "=", "",
             "CREATE CONSTRAINT chapter_id IF NOT EXISTS", "FOR (c:Chapter) REQUIRE c.chapter_number IS UNIQUE;", "",
             "CREATE CONSTRAINT article_id IF NOT EXISTS", "FOR (a:Article) REQUIRE a.article_id IS UNIQUE;", "",
             "CREATE CONSTRAINT entity_id IF NOT EXISTS", "FOR (e:Entity) REQUIRE e.entity_id IS UNIQUE;", "",
             "CREATE CONSTRAINT glossary_term IF NOT EXISTS", "FOR (g:GlossaryTerm) REQUIRE g.term IS UNIQUE;", "",
             "=", "// INDEXES", "=", "",
             "CREATE INDEX entity_type_idx IF NOT EXISTS", "FOR (e:Entity) ON (e.entity_type);", "",
             "CREATE INDEX entity_name_idx IF NOT EXISTS", "FOR (e:Entity) ON (e.name);", "",
             "CREATE INDEX article_title_idx IF NOT EXISTS", "FOR (a:Article) ON (a.title);", "",
             "CREATE FULLTEXT INDEX article_content_idx IF NOT EXISTS", "FOR (a:Article) ON EACH [a.summary];", "")
    + _fixed(10, "=", "// CHAPTER NODES", "=", "") + _fixed(20, "", "=", "// ARTICLE NODES", "=", "")
    + _fixed(30, "", "=", "// ENTITY NODES", "=", "") + _fixed(40, "", "=", "// GLOSSARY TERM NODES", "=", "")
    + _fixed(50, "", "=", "// RELATIONSHIPS", "=", "", "// Chapter -> Article relationships")
    + _fixed(60, "", "// Article -> Entity MENTIONS relationships") + _fixed(70, "", "// Semantic Entity -> Entity relationships"))
def graph_statements(spark, sf):
    """Every line; summaries are those of the enrichment."""
    found = dealt(st.mentions(spark, sf), "article_id")
    rels = rl.collect_relationships(rl.resolve_relationships(st.raw_relationships(found), found))
    arts = gr.article_nodes(st.articles(spark, sf), st.enrichment(spark, sf))
    lines = wr.graph_statements(st.chapters(spark, sf), arts, merge_entities(found), st.glossary(spark, sf), found, rels)
    return lines.select("k1", "line")


@register("chunk_statements", CHUNK_SQL
    + _fixed(0, "// Constraint for Chunk nodes", "CREATE CONSTRAINT chunk_id IF NOT EXISTS", "FOR (c:Chunk) REQUIRE c.chunk_id IS UNIQUE;", "",
             "=", "// CHUNK NODES", "=", "")
    + _fixed(2, "", "=", "// ARTICLE -> CHUNK RELATIONSHIPS", "=", "") + _fixed(4, "", "=", "// CHUNK -> ENTITY RELATIONSHIPS", "=", ""))
def chunk_statements(spark, sf):
    df = dealt(chunks(spark, sf).drop("text"), "source_article_id")
    links = dealt(link_mentions(df, st.mentions(spark, sf)), "source_article_id")
    return wr.chunk_statements(with_entity_ids(df, links), links).select("k1", "line")


@register("export_all", sql("""
SELECT 'nodes_chapters' AS name, count(*) AS n FROM chap UNION ALL SELECT 'nodes_articles', count(*) FROM doc UNION ALL SELECT 'nodes_entities', count(*) FROM entity
UNION ALL SELECT 'nodes_glossary', count(*) FROM term UNION ALL SELECT 'nodes_chunks', count(*) FROM chunk UNION ALL SELECT 'rels_contains', count(*) FROM doc
UNION ALL SELECT 'rels_mentions', count(*) FROM mention UNION ALL SELECT 'rels_semantic', count(*) FROM relation UNION ALL SELECT 'rels_article_chunk', count(*) FROM chunk
UNION ALL SELECT 'rels_chunk_entity', count(*) FROM link UNION ALL SELECT 'chunks', count(*) FROM chunk UNION ALL SELECT 'embeddings', count(*) FROM chunk
UNION ALL SELECT 'entity ids of chunks', count(*) FROM link""", "chap", "doc", "entity", "term", "chunk", "mention", "relation", "link"))
def export_all(spark, sf):
    """Every node, edge, chunk and vector file, read back and counted; chunk records hold their entity ids."""
    out, arts, found, df = folder(spark), st.articles(spark, sf), dealt(st.mentions(spark, sf), "article_id"), written(chunks(spark, sf), "chunks", "source_article_id")
    links = dealt(link_mentions(df, found), "source_article_id")
    linked = with_entity_ids(df, links)  # its texts are read by the records only and are not written again
    rels = rl.collect_relationships(rl.resolve_relationships(st.raw_relationships(found), found))
    graph = export_graph({
        "nodes_chapters": gr.chapter_nodes(st.chapters(spark, sf)), "nodes_articles": gr.article_nodes(arts, st.enrichment(spark, sf)),
        "nodes_entities": gr.entity_nodes(merge_entities(found)), "nodes_glossary": gr.glossary_nodes(st.glossary(spark, sf)),
        "nodes_chunks": gr.chunk_nodes(linked), "rels_contains": gr.contains_edges(arts), "rels_mentions": gr.mentions_edges(found),
        "rels_semantic": gr.semantic_edges(rels), "rels_article_chunk": gr.article_chunk_edges(df), "rels_chunk_entity": gr.chunk_entity_edges(links)}, out, "gzip")
    paths = export_chunks(linked, out, embed_chunks(df), "gzip")
    records = spark.read.schema("chunk_id string, entity_ids array<string>").json(paths["chunks"])
    tables = {name: rd.read_graph_csv(spark, path) for name, path in graph.items()}
    tables |= {"chunks": records, "embeddings": rd.read_embeddings(spark, paths["embeddings"])}
    counts = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, d in tables.items()]
    ids = records.agg(F.coalesce(F.sum(F.size("entity_ids")), F.lit(0)).alias("n"))
    return wr.union_all([*counts, ids.select(F.lit("entity ids of chunks").alias("name"), "n")])


@register("enriched_guide_round_trip", sql("""
SELECT 'article' AS kind, article_id AS key, CASE WHEN lang = 'en' THEN string_split(text, chr(10))[1] END AS value, NULL::BIGINT AS n FROM doc
UNION ALL SELECT 'mention', article_id, entity_id || ' ' || source_text || ' ' || alignment_status, start_pos FROM mention
UNION ALL SELECT 'entity', entity_id, source_article_id || ' ' || name || ' ' || matched, end_pos FROM entity
UNION ALL SELECT 'article relationship', source_article_id, relationship_id || ' ' || source_text, NULL FROM rel
UNION ALL SELECT 'relationship', relationship_id, source_entity_id || ' ' || relationship_type || ' ' || target_entity_id, NULL FROM relation
UNION ALL SELECT 'term', term, related_terms || ' ' || related_chapters || ' ' || related_entity_ids, NULL FROM (
""", "doc", "mention", "entity", "rel", "relation") + ORACLES["enrich_glossary"] + ")")
def enriched_guide_round_trip(spark, sf):
    """Every part of the enriched guide, written as one document and read back."""
    found = dealt(st.mentions(spark, sf), "article_id")
    rels = dealt(rl.resolve_relationships(st.raw_relationships(found), found), "source_article_id")
    merged = written(merge_entities(found))
    path = write_enriched_guide(
        folder(spark), "gzip", articles=st.articles(spark, sf), mentions=found, entities=merged, article_relationships=rels,
        relationships=written(rl.collect_relationships(rels)), glossary=enrich_glossary(st.glossary(spark, sf), merged), enrichment=st.enrichment(spark, sf))
    back = read_enriched_guide(spark, path)

    def rows(name, kind, key, value, n=None):
        return back[name].select(F.lit(kind).alias("kind"), F.col(key).alias("key"), value.alias("value"), (F.col(n) if n else F.lit(None)).cast("long").alias("n"))

    def joined(*columns):
        return F.concat(*[x for c in columns for x in (F.lit(" "), c if not isinstance(c, str) else F.col(c))][1:])

    return wr.union_all([
        rows("articles", "article", "article_id", F.col("summary")),
        rows("mentions", "mention", "source_article_id", joined("entity_id", "source_text", "alignment_status"), "start_pos"),
        rows("entities", "entity", "entity_id", joined("source_article_id", "name", F.col("attributes")["matched"]), "end_pos"),
        rows("article_relationships", "article relationship", "source_article_id", joined("relationship_id", "source_text")),
        rows("relationships", "relationship", "relationship_id", joined("source_entity_id", "relationship_type", "target_entity_id")),
        rows("glossary", "term", "term", joined(*[F.array_join(c, "|") for c in ("related_terms", "related_chapters", "related_entity_ids")])),
        rows("unread", "unread", "line", F.lit(None).cast("string"))])
