"""Readers, writers and incremental runs. Files go to the shared folder, one subfolder per run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pageloom.functions.text import chapter_of
from pageloom.functions.urls import fix_typos
from pageloom.operators import graph as gr
from pageloom.operators.dom import parse_pages
from pageloom.operators.extract import columns, title
from pageloom.operators.mentions import extract_mentions
from pageloom.plans import standins as st
from pageloom.plans.checks import ORACLES, html, register  # noqa: F401  (the titles' SQL is filed by html)
from pageloom.plans.checks.ctes import sql
from pageloom.plans.checks import graph  # noqa: F401  (files the SQL of merged entities)
from pageloom.plans.checks.lookup import embedded
from pageloom.plans.checks.text import chunks, ints
from pageloom.session import shared_dir, written
from pageloom.sources import readers as rd
from pageloom.sources import writers as wr
from pageloom.streaming import incremental as inc
from pageloom.streaming.entities import EntityState

TITLE = "The Guide"


def folder(spark) -> str:
    return f"{shared_dir(spark)}/pageloom-{uuid.uuid4().hex}"


@register("graph_csv_round_trip", sql("""
SELECT article_id, title, url, CASE WHEN lang = 'en' THEN left(string_split(text, chr(10))[1], 500) ELSE '' END AS summary, word_count, chapter_number FROM doc""", "doc"))
def graph_csv_round_trip(spark, sf):
    """Article nodes through a typed CSV and back."""
    nodes = gr.article_nodes(st.articles(spark, sf), st.enrichment(spark, sf))
    return rd.read_graph_csv(spark, wr.write_graph_csv(nodes, "nodes_articles", folder(spark)))


@register("edge_csv_round_trip", sql("SELECT article_id AS start_id, entity_id AS end_id, confidence, 'MENTIONS' AS type FROM mention", "mention"))
def edge_csv_round_trip(spark, sf):
    return rd.read_graph_csv(spark, wr.write_graph_csv(gr.mentions_edges(st.mentions(spark, sf)), "rels_mentions", folder(spark)))


@register("embeddings_jsonl_round_trip", sql("SELECT chunk_id, 'hashed-words' AS model_id, 64 AS dimensions FROM chunk", "chunk"))
def embeddings_jsonl_round_trip(spark, sf):
    path = wr.write_jsonl(wr.embedding_records(embedded(spark, sf)), folder(spark) + "/embeddings")
    return ints(rd.read_embeddings(spark, path).select("chunk_id", "model_id", F.size("embedding").alias("dimensions")), "dimensions")


@register("state_records", "SELECT doc_id, lang FROM documents WHERE doc_id % 10 <> 3")
def state_records(spark, sf):
    """Saved records of which every tenth is broken; the broken ones are set aside."""
    path = folder(spark) + "/state"
    good = F.to_json(F.struct("doc_id", "lang"))
    lines = st.table(spark, sf, "documents").select(F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit("{broken "), good)).otherwise(good).alias("v"))
    lines.write.text(path)
    good, _ = rd.read_state(spark, path, "doc_id long, lang string", one_per_file=False)
    return good.select("doc_id", "lang")


@register("jsonl_records", sql("""
SELECT 'article' AS type, 'The Guide' AS guide_title, c.title AS chapter_title, article_id, d.title, word_count, NULL AS term, NULL AS definition FROM doc d JOIN chap c USING (chapter_number)
UNION ALL SELECT 'glossary_term', 'The Guide', NULL, NULL, NULL, NULL, term, definition FROM term""", "doc", "chap", "term"))
def jsonl_records(spark, sf):
    df = wr.jsonl_records(st.articles(spark, sf), st.chapters(spark, sf), st.glossary(spark, sf), TITLE)
    return df.select("type", "guide_title", "chapter_title", "article_id", "title", "word_count", "term", "definition")


@register("guide_json_lines", sql("""
SELECT 0 AS k1, 0 AS k2, '{"metadata":{"title":"The Guide","publisher":"Example"},"chapters":[' AS line
UNION ALL SELECT 1, chapter_number, CASE WHEN chapter_number = 1 THEN '' ELSE ',' END || rtrim(to_json({'chapter_number': chapter_number, 'title': title, 'overview_url': overview_url,
  'article_count': (SELECT count(*) FROM doc d WHERE d.chapter_number = c.chapter_number), 'total_word_count': (SELECT sum(word_count)::BIGINT FROM doc d WHERE d.chapter_number = c.chapter_number)})::VARCHAR, '}') || ',"articles":[' FROM chap c
UNION ALL SELECT 1, chapter_number, CASE WHEN article_number = 0 THEN '' ELSE ',' END || to_json({'article_id': article_id, 'chapter_number': chapter_number, 'article_number': article_number, 'title': title, 'url': url,
  'content_type': CASE WHEN article_number = 0 THEN 'chapter_overview' ELSE 'article' END, 'markdown_content': text, 'word_count': word_count, 'char_count': char_count, 'raw_html': NULL})::VARCHAR FROM doc
UNION ALL SELECT 1, chapter_number, ']}' FROM chap
UNION ALL SELECT 2, 0, '],"glossary":{"terms":['
UNION ALL SELECT 3, seq, CASE WHEN seq = (SELECT min(seq) FROM term) THEN '' ELSE ',' END || to_json({'term': term, 'definition': definition})::VARCHAR FROM term
UNION ALL SELECT 4, 0, ']}}'""", "doc", "chap", "term"))
def guide_json_lines(spark, sf):
    arts = st.articles(spark, sf).drop("sections")
    lines = wr.guide_json_lines(arts, st.chapters(spark, sf), st.glossary(spark, sf), {"title": TITLE, "publisher": "Example"})
    return lines.select("k1", "k2", "line")


#: The lines of the book below its header.
BOOK_SQL = sql("""
SELECT 3 AS k1, chapter_number AS k2, '# Chapter ' || chapter_number || ': ' || title AS line FROM chap UNION ALL SELECT 3, chapter_number, '' FROM chap
UNION ALL SELECT 3, chapter_number, unnest([CASE WHEN article_number = 0 THEN '## Overview' ELSE '## ' || article_number || '. ' || title END, '', '*Source: ' || url || '*', '', text, '', '---', '']) FROM doc
UNION ALL SELECT 1, chapter_number, '- **Chapter ' || chapter_number || '**: ' || title FROM chap UNION ALL SELECT 1, chapter_number, '  - ' || title FROM doc WHERE article_number > 0
UNION ALL SELECT 2, 0, unnest(['', '---', '']) UNION ALL SELECT 4, 0, unnest(['# Glossary', ''])
UNION ALL SELECT 5, seq, unnest(['**' || term || '**: ' || definition, '']) FROM term""", "doc", "chap", "term")

_ESC = "replace(replace(replace({}, '\\', '\\\\'), '''', '\\'''), chr(10), ' ')"


#: Node and edge statements without article nodes and headings.
GRAPH_SQL = sql(f"""
SELECT 11 AS k1, 'CREATE (:Chapter {{chapter_number: ' || chapter_number || ', title: ''' || {_ESC.format("title")} || ''', url: ''' || overview_url || '''}});' AS line FROM chap
UNION ALL SELECT 31, 'CREATE (:Entity:' || upper(left(replace(entity_type, '_', ''), 1)) || substr(replace(entity_type, '_', ''), 2) || ' {{entity_id: ''' || entity_id || ''', name: ''' || name || ''', entity_type: ''' || entity_type
  || ''', source_text: ''' || source_text || ''', source_article_id: ''' || source_article_id || ''', confidence: ' || confidence || ', matched: ''' || matched || '''}});' FROM entity
UNION ALL SELECT 41, 'CREATE (:GlossaryTerm {{term: ''' || term || ''', definition: ''' || {_ESC.format("left(definition, 500)")} || '''}});' FROM term
UNION ALL SELECT 51, 'MATCH (c:Chapter {{chapter_number: ' || chapter_number || '}})' || chr(10) || 'MATCH (a:Article {{article_id: ''' || article_id || '''}})' || chr(10) || 'CREATE (c)-[:CONTAINS]->(a);' FROM doc
UNION ALL SELECT 61, 'MATCH (a:Article {{article_id: ''' || article_id || '''}})' || chr(10) || 'MATCH (e:Entity {{entity_id: ''' || entity_id || '''}})' || chr(10) || 'CREATE (a)-[:MENTIONS {{confidence: ' || confidence || '}}]->(e);' FROM mention
UNION ALL SELECT 71, 'MATCH (s:Entity {{entity_id: ''' || source_entity_id || '''}})' || chr(10) || 'MATCH (t:Entity {{entity_id: ''' || target_entity_id || '''}})' || chr(10) || 'CREATE (s)-[:' || relationship_type || ' {{confidence: 1.0, evidence: ''' || source_text || '''}}]->(t);' FROM relation""",
    "chap", "doc", "entity", "term", "mention", "relation")

#: Chunk statements without headings.
CHUNK_SQL = sql(f"""
SELECT 1 AS k1, 'CREATE (:Chunk {{chunk_id: ''' || chunk_id || ''', chunk_type: ''' || chunk_type || ''', source_article_id: ''' || source_article_id || ''', heading: ''' || {_ESC.format("heading").replace("' ')", "chr(92) || 'n')")}
  || ''', chapter_number: ' || chapter_number || ', token_count: ' || token_count || ', word_count: ' || word_count || ', char_start: ' || char_start || ', char_end: ' || char_end || ', entity_count: ' || coalesce(n, 0) || '}});' AS line
FROM chunk LEFT JOIN (SELECT chunk_id, count(*) AS n FROM link GROUP BY 1) USING (chunk_id)
UNION ALL SELECT 3, 'MATCH (a:Article {{article_id: ''' || source_article_id || '''}})' || chr(10) || 'MATCH (c:Chunk {{chunk_id: ''' || chunk_id || '''}})' || chr(10) || 'CREATE (a)-[:HAS_CHUNK]->(c);' FROM chunk
UNION ALL SELECT 5, 'MATCH (c:Chunk {{chunk_id: ''' || chunk_id || '''}})' || chr(10) || 'MATCH (e:Entity {{entity_id: ''' || entity_id || '''}})' || chr(10) || 'CREATE (c)-[:MENTIONS_ENTITY]->(e);' FROM link""", "chunk", "link")


@register("url_typos", "SELECT page_id, replace(url, 'example.net', 'example.org') AS url FROM pages")
def url_typos(spark, sf):
    return st.table(spark, sf, "pages").select("page_id", fix_typos(F.col("url"), {"example.net": "example.org"}).alias("url"))


# ---- incremental ---------------------------------------------------------------------------------

STATE = "article_id string, text_md5 string, chapter int"


def _work(df):
    return df.select("article_id", "text_md5", chapter_of(F.col("article_id")).alias("chapter"))


@register("resume_enrichment", ORACLES["merge_entities"])
def resume_enrichment(spark, sf):
    """Extraction and merge in three runs, and equal to one: first a third of the articles, some with another text and some
    that are later removed; then all, some still different; then all as they are."""
    arts, names = written(st.articles(spark, sf)), st.gazetteer(spark, sf)
    state = EntityState(spark, folder(spark))
    other = F.concat(F.lit("Anhaha erlyen "), F.reverse("markdown_content"))
    early = arts.where("article_number % 3 = 0").withColumn("markdown_content", F.when(F.col("article_number") % 2 == 0, other).otherwise(F.col("markdown_content")))
    removed = arts.where("article_number % 7 = 1").withColumn("article_id", F.concat("article_id", F.lit("-old")))
    second = arts.withColumn("markdown_content", F.when(F.col("article_number") % 5 == 0, other).otherwise(F.col("markdown_content")))
    for run, given in enumerate((early.unionByName(removed), second, arts)):
        found = state.update(given, lambda some: extract_mentions(some, names, max_words=1), run)
    df = found.select(
        "entity_id", "entity_type", "name", "source_text", "start_pos", "end_pos", "source_article_id", "alignment_status",
        "confidence", F.col("attributes")["matched"].alias("matched"))
    return ints(df, "start_pos", "end_pos")


@register("resume_embedding", sql("SELECT chunk_id, md5(text) AS text_md5, 'hashed-words' AS model_id FROM chunk", "chunk"))
def resume_embedding(spark, sf):
    """Vectors are reused by chunk, text and model."""
    from pageloom.operators.vectors import embed_chunks

    path, ddl = folder(spark) + "/vectors", "chunk_id string, text_md5 string, model_id string, embedding array<double>"
    df = inc.with_fingerprint(chunks(spark, sf), "text").select("chunk_id", "text", "text_md5", "chunk_type").withColumn("model_id", F.lit("hashed-words"))

    def work(todo):
        return todo.select("chunk_id", "text_md5").join(embed_chunks(todo.select("chunk_id", "text")), "chunk_id").select("chunk_id", "text_md5", "model_id", "embedding")

    keys = ["chunk_id", "text_md5", "model_id"]
    inc.resume(df.filter("chunk_type = 'article_summary'"), path, keys, work, ddl)
    return inc.resume(df, path, keys, work, ddl).select(*keys)


@register("reset_state", "SELECT 0::BIGINT AS n FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)")
def reset_state(spark, sf):
    path = folder(spark) + "/state"
    inc.resume(inc.with_fingerprint(st.articles(spark, sf), "markdown_content"), path, ["article_id", "text_md5"], _work, STATE)
    inc.reset_state(spark, path, STATE)
    return inc.read_state_table(spark, path, STATE).agg(F.count(F.lit(1)).alias("n"))


@register("stream_pages", ORACLES["page_titles"].replace("SELECT page_id,", "SELECT page_id, url,", 1) + " WHERE html IS NOT NULL")
def stream_pages(spark, sf):
    """The page table as a stream of several micro-batches, the second and third with pages of the ones before again; a second
    run over the same state adds nothing."""
    out = folder(spark)
    pages = st.table(spark, sf, "pages").select("page_id", "url", "html")
    for k, part in enumerate(("page_id % 3 = 0", "page_id % 3 < 2", "true")):
        pages.where(part).write.parquet(f"{out}/pages/part={k}")
    source = spark.readStream.schema("page_id long, url string, html string").option("maxFilesPerTrigger", 8).option(
        "recursiveFileLookup", True).parquet(f"{out}/pages")

    def work(df):
        return columns(parse_pages(df), title=title(st.SITE)).select("page_id", "url", "title")

    for _ in range(2):
        inc.run_stream(source, ["page_id"], work, f"{out}/articles", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/articles").select("page_id", "url", "title")
