"""Sinks: JSON records, nested guide, Markdown book, typed CSV and statement scripts.

Ordered outputs are tables of text lines with sort keys. ``write_lines`` sorts them by range, so any
size streams through; nothing is gathered into one string, one group or the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import cap, escape, type_label
from pageloom.session import release

LINE_KEYS = ["k1", "k2", "k3", "k4"]


def _lines(df: DataFrame, k1, k2, k3, k4, line: Column) -> DataFrame:
    keys = [k if isinstance(k, Column) else F.lit(k) for k in (k1, k2, k3, k4)]
    kinds = ["long", "long", "string", "long"]
    return df.select(*[k.cast(t).alias(n) for k, t, n in zip(keys, kinds, LINE_KEYS, strict=True)], line.alias("line"))


def _fixed(spark, k1: int, texts: list[str]) -> DataFrame:
    rows = [(k1, 0, "", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "k1 long, k2 long, k3 string, k4 long, line string")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _done(df: DataFrame, path: str) -> str:
    release(df.sparkSession)
    return path


def write_lines(lines: DataFrame, path: str, compression: str | None = None) -> str:
    """Part files in name order hold the lines in key order. They are plain unless a ``compression`` is named."""
    lines.orderBy(*LINE_KEYS).select("line").write.mode("overwrite").text(path, compression=compression)
    return _done(lines, path)


# ---- JSON ----------------------------------------------------------------------------------------

ARTICLE_FIELDS = [
    "article_id", "chapter_number", "article_number", "title", "url", "content_type", "markdown_content", "sections",
    "summary", "key_concepts", "links", "images", "videos", "webinars", "related", "scraped_at", "word_count", "char_count",
]
TERM_FIELDS = ["term", "acronym", "definition", "related_terms", "related_chapters"]


def jsonl_records(articles: DataFrame, chapters: DataFrame, glossary: DataFrame, guide_title: str) -> DataFrame:
    """Every article with its chapter's title, then every term; columns a kind lacks are null."""
    fields = [c for c in ARTICLE_FIELDS if c in articles.columns]
    a = articles.join(chapters.select("chapter_number", F.col("title").alias("chapter_title")), "chapter_number", "left")
    a = a.select(F.lit("article").alias("type"), F.lit(guide_title).alias("guide_title"), "chapter_title", *fields)
    g = glossary.select(F.lit("glossary_term").alias("type"), F.lit(guide_title).alias("guide_title"),
                        *[c for c in TERM_FIELDS if c in glossary.columns])
    return a.unionByName(g, allowMissingColumns=True)


CHUNK_FIELDS = [
    "chunk_id", "chunk_type", "source_article_id", "source_section_index", "text", "char_start", "char_end", "entity_ids",
    "heading", "chapter_number", "article_title", "token_count", "word_count", "entity_count",
]


def chunk_records(chunks: DataFrame) -> DataFrame:
    return chunks.select(*CHUNK_FIELDS)


def embedding_records(embeddings: DataFrame) -> DataFrame:
    at = F.col("embedded_at") if "embedded_at" in embeddings.columns else F.current_timestamp()
    return embeddings.select(
        "chunk_id", "embedding", "model_id", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("embedded_at"), "dimensions"
    )


def write_jsonl(df: DataFrame, path: str, compression: str | None = None) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path, compression=compression)
    return _done(df, path)


def guide_json_lines(
    articles: DataFrame, chapters: DataFrame, glossary: DataFrame, metadata: dict[str, str], totals: bool = False,
    glossary_url: str | None = None,
) -> DataFrame:
    """The nested guide as lines of one JSON document: opening, chapter heads, one line per article,
    closings. Raw HTML is not part of it; its key stays, as null. Fields that a table lacks are left out.
    ``totals`` adds the glossary's address and number of terms and the guide's numbers of articles and words."""
    spark = articles.sparkSession
    fields = [c for c in ARTICLE_FIELDS if c in articles.columns]
    body = F.to_json(F.struct(*fields, F.lit(None).cast("string").alias("raw_html")), {"ignoreNullFields": "false"})
    leads = articles.groupBy("chapter_number").agg(F.min(F.struct("article_number", "article_id")).alias("_lead"))
    sums = articles.groupBy("chapter_number").agg(
        F.count(F.lit(1)).alias("article_count"), F.sum("word_count").alias("total_word_count"))
    a = articles.join(leads, "chapter_number")
    comma = F.when(F.struct("article_number", "article_id") == F.col("_lead"), "").otherwise(",")
    first_chapter = chapters.agg(F.min("chapter_number").alias("_first"))
    c = chapters.join(sums, "chapter_number", "left").withColumn("_one", F.lit(1)).join(
        first_chapter.withColumn("_one", F.lit(1)), "_one")
    described = [F.col("description")] if "description" in chapters.columns else []
    head = F.to_json(F.struct("chapter_number", "title", "overview_url", *described,
                              F.coalesce("article_count", F.lit(0)).alias("article_count"),
                              F.coalesce("total_word_count", F.lit(0)).alias("total_word_count")), {"ignoreNullFields": "false"})
    opened = F.concat(F.when(F.col("chapter_number") == F.col("_first"), "").otherwise(","),
                      F.regexp_replace(head, r"\}\z", ',"articles":['))
    meta = spark.range(1).select(F.to_json(F.create_map(*[F.lit(x) for kv in metadata.items() for x in kv])).alias("m"))
    g = glossary.withColumn("_one", F.lit(1)).join(
        glossary.agg(F.min("seq").alias("_first"), F.lit(1).alias("_one")), "_one")
    term = F.concat(F.when(F.col("seq") == F.col("_first"), "").otherwise(","), F.to_json(F.struct(*[c for c in TERM_FIELDS if c in glossary.columns])))
    last = _fixed(spark, 4, ["]}}"])
    if totals:
        words = articles.agg(F.count(F.lit(1)).alias("total_articles"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("total_word_count"))
        terms = glossary.agg(F.lit(glossary_url).alias("url"), F.count(F.lit(1)).alias("term_count"))
        tail = [terms.select(F.concat(F.lit("],"), F.regexp_replace(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), r"^\{", "")).alias("line")),
                words.select(F.concat(F.lit(","), F.regexp_replace(F.to_json(F.struct("*")), r"^\{", "")).alias("line"))]
        last = union_all([_lines(t, 4 + i, 0, "", 0, F.col("line")) for i, t in enumerate(tail)])
    return union_all([
        _lines(meta, 0, 0, "", 0, F.concat(F.lit('{"metadata":'), F.col("m"), F.lit(',"chapters":['))),
        _lines(c, 1, F.col("chapter_number"), "", -1, opened),
        _lines(a, 1, F.col("chapter_number"), "", F.col("article_number"), F.concat(comma, body)),
        _lines(c, 1, F.col("chapter_number"), "~", 0, F.lit("]}")),
        _fixed(spark, 2, ['],"glossary":{"terms":[']),
        _lines(g, 3, F.col("seq"), "", 0, term),
        last,
    ])


def write_guide_json(articles, chapters, glossary, metadata, path: str, totals: bool = False, glossary_url: str | None = None) -> str:
    return write_lines(guide_json_lines(articles, chapters, glossary, metadata, totals, glossary_url), path)


# ---- Markdown book -------------------------------------------------------------------------------


def book_lines(
    articles: DataFrame, chapters: DataFrame, glossary: DataFrame, title: str, publisher: str, scraped: str | None = None
) -> DataFrame:
    """Header, contents, chapters with their articles, glossary. An article's text is one line entry,
    its webinars, related links and videos follow it. ``scraped`` is the date in the header, today if not given."""
    spark = articles.sparkSession
    n, m = F.col("chapter_number"), F.col("article_number")
    head = spark.range(1).select(F.posexplode(F.array(
        F.lit(f"# {title}"), F.lit(""), F.lit(f"*Published by {publisher}*"),
        F.concat(F.lit("*Scraped on "), F.lit(scraped) if scraped else F.date_format(F.current_timestamp(), "yyyy-MM-dd"), F.lit("*")),
        F.lit(""), F.lit("---"), F.lit(""), F.lit("## Table of Contents"), F.lit(""))).alias("i", "t"))
    listed = articles.filter("article_number > 0")
    heading = F.when(m == 0, F.lit("## Overview")).otherwise(F.concat(F.lit("## "), m.cast("string"), F.lit(". "), F.col("title")))

    def extra(part: str, name: str, entry) -> Column:
        if part not in articles.columns:
            return F.array().cast("array<string>")
        items = F.flatten(F.transform(part, entry))
        return F.when(F.size(part) > 0, F.concat(F.array(F.lit(""), F.lit(f"### {name}"), F.lit("")), items)).otherwise(
            F.array().cast("array<string>"))

    def link(x, text=None, mark=""):
        return F.concat(F.lit(f"- {mark}["), x["title"] if text is None else text, F.lit("]("), x["url"], F.lit(f"){mark}"))

    block = F.concat(
        F.array(heading, F.lit(""), F.concat(F.lit("*Source: "), F.col("url"), F.lit("*")), F.lit(""), F.col("markdown_content")),
        extra("webinars", "Webinars", lambda w: F.when(
            F.coalesce(w["description"], F.lit("")) != "",
            F.array(link(w, mark="**"), F.concat(F.lit("  - "), w["description"]))).otherwise(F.array(link(w, mark="**")))),
        extra("related", "Related Articles", lambda r: F.array(link(r))),
        extra("videos", "Videos", lambda v: F.array(link(v, F.coalesce(
            F.nullif(v["title"], F.lit("")), F.concat(F.lit("Video ("), v["video_id"], F.lit(")")))))),
        F.array(F.lit(""), F.lit("---"), F.lit("")),
    )
    body = articles.select(n, m, F.posexplode(block).alias("i", "t"))
    chapter_head = chapters.select(n, F.posexplode(F.array(
        F.concat(F.lit("# Chapter "), n.cast("string"), F.lit(": "), F.col("title")), F.lit(""))).alias("i", "t"))
    terms = glossary.select("seq", F.posexplode(F.array(
        F.concat(F.lit("**"), F.col("term"), F.lit("**: "), F.col("definition")), F.lit(""))).alias("i", "t"))
    return union_all([
        _lines(head, 0, 0, "", F.col("i"), F.col("t")),
        _lines(chapters, 1, n, "", -1, F.concat(F.lit("- **Chapter "), n.cast("string"), F.lit("**: "), F.col("title"))),
        _lines(listed, 1, n, "", m, F.concat(F.lit("  - "), F.col("title"))),
        _fixed(spark, 2, ["", "---", ""]),
        _lines(chapter_head, 3, n, "", F.col("i"), F.col("t")),
        _lines(body, 3, n, F.lpad(m.cast("string"), 12, "0"), F.col("i"), F.col("t")),
        _fixed(spark, 4, ["# Glossary", ""]),
        _lines(terms, 5, F.col("seq"), "", F.col("i"), F.col("t")),
    ])


# ---- typed CSV -----------------------------------------------------------------------------------

# Typed headers of the node and edge files.
HEADERS = {
    "nodes_chapters": {"chapter_number": "chapter_number:ID(Chapter)", "title": "title", "url": "url", "label": ":LABEL"},
    "nodes_articles": {"article_id": "article_id:ID(Article)", "title": "title", "url": "url", "summary": "summary",
                       "word_count": "word_count:int", "chapter_number": "chapter_number:int", "label": ":LABEL"},
    "nodes_entities": {"entity_id": "entity_id:ID(Entity)", "name": "name", "entity_type": "entity_type",
                       "source_text": "source_text", "source_article_id": "source_article_id", "confidence": "confidence:float",
                       "definition": "definition", "vendor": "vendor", "organization": "organization", "impact": "impact",
                       "benefit": "benefit", "label": ":LABEL"},
    "nodes_glossary": {"term": "term:ID(GlossaryTerm)", "definition": "definition", "label": ":LABEL"},
    "nodes_chunks": {"chunk_id": "chunk_id:ID(Chunk)", "chunk_type": "chunk_type", "source_article_id": "source_article_id",
                     "heading": "heading", "chapter_number": "chapter_number:int", "token_count": "token_count:int",
                     "word_count": "word_count:int", "char_start": "char_start:int", "char_end": "char_end:int",
                     "entity_count": "entity_count:int", "label": ":LABEL"},
    "rels_contains": {"src": ":START_ID(Chapter)", "dst": ":END_ID(Article)", "type": ":TYPE"},
    "rels_mentions": {"src": ":START_ID(Article)", "dst": ":END_ID(Entity)", "confidence": "confidence:float", "type": ":TYPE"},
    "rels_semantic": {"src": ":START_ID(Entity)", "dst": ":END_ID(Entity)", "confidence": "confidence:float",
                      "evidence": "evidence", "type": ":TYPE"},
    "rels_article_chunk": {"src": ":START_ID(Article)", "dst": ":END_ID(Chunk)", "type": ":TYPE"},
    "rels_chunk_entity": {"src": ":START_ID(Chunk)", "dst": ":END_ID(Entity)", "type": ":TYPE"},
}


def typed_header(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(c).alias(h) for c, h in HEADERS[name].items()])


def write_graph_csv(df: DataFrame, name: str, folder: str, compression: str | None = None) -> str:
    path = f"{folder}/{name}"
    typed_header(df, name).write.mode("overwrite").csv(
        path, header=True, escape='"', quote='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        compression=compression,
    )
    return _done(df, path)


# ---- statement scripts ---------------------------------------------------------------------------

RULE = "// " + "=" * 65


def _section(title: str) -> list[str]:
    return [RULE, f"// {title}", RULE, ""]


def _props(pairs: list[tuple[str, Column, bool]]) -> Column:
    """``key: value`` list; True marks text values, which get quotes."""
    out = []
    for i, (key, value, quoted) in enumerate(pairs):
        mark = "'" if quoted else ""
        out += [F.lit((", " if i else "") + f"{key}: {mark}"), value.cast("string"), F.lit(mark)]
    return F.concat(*out)


def _node(label: Column | str, props: Column) -> Column:
    label = F.lit(label) if isinstance(label, str) else label
    return F.concat(F.lit("CREATE (:"), label, F.lit(" {"), props, F.lit("});"))


def _edge(a: tuple[str, str, str, str], b: tuple[str, str, str, str], rel: Column) -> Column:
    """Ends are ``(variable, label, key, column)``; a chapter number goes unquoted."""
    parts = []
    for var, label, key, column in (a, b):
        mark = "" if key == "chapter_number" else "'"
        parts += [F.lit(f"MATCH ({var}:{label} {{{key}: {mark}"), F.col(column), F.lit(f"{mark}}})\n")]
    return F.concat(*parts, F.lit(f"CREATE ({a[0]})-["), rel, F.lit(f"]->({b[0]});"))


# Constraints and indexes that the statement file declares.
CONSTRAINTS = [("chapter_id", "c:Chapter", "c.chapter_number"), ("article_id", "a:Article", "a.article_id"),
               ("entity_id", "e:Entity", "e.entity_id"), ("glossary_term", "g:GlossaryTerm", "g.term")]
INDEXES = [("INDEX", "entity_type_idx", "(e:Entity)", "(e.entity_type)"), ("INDEX", "entity_name_idx", "(e:Entity)", "(e.name)"),
           ("INDEX", "article_title_idx", "(a:Article)", "(a.title)"),
           ("FULLTEXT INDEX", "article_content_idx", "(a:Article)", "EACH [a.summary]")]


def graph_statements(
    chapters: DataFrame, articles: DataFrame, entities: DataFrame, glossary: DataFrame, mentions: DataFrame,
    relationships: DataFrame,
) -> DataFrame:
    """Statement lines in fixed section order: constraints, indexes, nodes by label, then edges.
    ``articles`` are article nodes, ``entities`` merged entities, ``glossary`` carries ``seq``."""
    spark = chapters.sparkSession
    setup = _section("CONSTRAINTS")
    for name, node, key in CONSTRAINTS:
        setup += [f"CREATE CONSTRAINT {name} IF NOT EXISTS", f"FOR ({node}) REQUIRE {key} IS UNIQUE;", ""]
    setup += _section("INDEXES")
    for kind, name, node, on in INDEXES:
        setup += [f"CREATE {kind} {name} IF NOT EXISTS", f"FOR {node} ON {on};", ""]
    extra = F.transform(
        F.array_sort(F.map_entries("attributes")),
        lambda e: F.concat(F.lit(", "), e["key"], F.lit(": '"), escape(cap(e["value"], 200)), F.lit("'")))
    entity = F.concat(_props([
        ("entity_id", F.col("entity_id"), True), ("name", escape(F.col("name")), True),
        ("entity_type", F.col("entity_type"), True), ("source_text", escape(cap(F.col("source_text"), 200)), True),
        ("source_article_id", F.col("source_article_id"), True), ("confidence", F.col("confidence"), False),
    ]), F.array_join(extra, ""))
    evidence = F.when(
        F.coalesce("source_text", F.lit("")) != "",
        F.concat(F.lit(", evidence: '"), escape(cap(F.col("source_text"), 200)), F.lit("'"))).otherwise("")
    chapter = ("c", "Chapter", "chapter_number", "chapter_number")
    article = ("a", "Article", "article_id", "article_id")
    return union_all([
        _fixed(spark, 0, setup),
        _fixed(spark, 10, _section("CHAPTER NODES")),
        _lines(chapters, 11, F.col("chapter_number"), "", 0, _node("Chapter", _props([
            ("chapter_number", F.col("chapter_number"), False), ("title", escape(F.col("title")), True),
            ("url", escape(F.col("overview_url")), True)]))),
        _fixed(spark, 20, ["", *_section("ARTICLE NODES")]),
        _lines(articles, 21, F.col("chapter_number"), F.col("article_id"), 0, _node("Article", _props([
            ("article_id", F.col("article_id"), True), ("title", escape(F.col("title")), True),
            ("url", escape(F.col("url")), True), ("summary", escape(F.col("summary")), True),
            ("word_count", F.col("word_count"), False), ("chapter_number", F.col("chapter_number"), False)]))),
        _fixed(spark, 30, ["", *_section("ENTITY NODES")]),
        _lines(entities, 31, 0, F.col("entity_id"), 0,
               _node(F.concat(F.lit("Entity:"), type_label(F.col("entity_type"))), entity)),
        _fixed(spark, 40, ["", *_section("GLOSSARY TERM NODES")]),
        _lines(glossary, 41, F.col("seq"), "", 0, _node("GlossaryTerm", _props([
            ("term", escape(F.col("term")), True), ("definition", escape(cap(F.col("definition"), 500)), True)]))),
        _fixed(spark, 50, ["", *_section("RELATIONSHIPS"), "// Chapter -> Article relationships"]),
        _lines(articles, 51, F.col("chapter_number"), F.col("article_id"), 0, _edge(chapter, article, F.lit(":CONTAINS"))),
        _fixed(spark, 60, ["", "// Article -> Entity MENTIONS relationships"]),
        _lines(mentions, 61, F.col("chapter_number"), F.col("article_id"), F.col("position"), _edge(
            article, ("e", "Entity", "entity_id", "entity_id"),
            F.concat(F.lit(":MENTIONS {confidence: "), F.col("confidence").cast("string"), F.lit("}")))),
        _fixed(spark, 70, ["", "// Semantic Entity -> Entity relationships"]),
        _lines(relationships, 71, F.col("chapter_number"), F.col("relationship_id"), 0, _edge(
            ("s", "Entity", "entity_id", "source_entity_id"), ("t", "Entity", "entity_id", "target_entity_id"),
            F.concat(F.lit(":"), F.col("relationship_type"), F.lit(" {confidence: "), F.col("confidence").cast("string"),
                     evidence, F.lit("}")))),
    ])


def chunk_statements(chunks: DataFrame, chunk_entities: DataFrame) -> DataFrame:
    """Statement lines for chunk nodes and their two edge kinds; chunk text is left out."""
    spark = chunks.sparkSession
    heading = escape(F.coalesce("heading", F.lit("")), "\\n")
    node = _node("Chunk", _props([
        ("chunk_id", F.col("chunk_id"), True), ("chunk_type", F.col("chunk_type"), True),
        ("source_article_id", F.col("source_article_id"), True), ("heading", heading, True),
        ("chapter_number", F.coalesce("chapter_number", F.lit(0)), False), ("token_count", F.col("token_count"), False),
        ("word_count", F.col("word_count"), False), ("char_start", F.col("char_start"), False),
        ("char_end", F.col("char_end"), False), ("entity_count", F.col("entity_count"), False)]))
    chunk = ("c", "Chunk", "chunk_id", "chunk_id")
    return union_all([
        _fixed(spark, 0, ["// Constraint for Chunk nodes", "CREATE CONSTRAINT chunk_id IF NOT EXISTS",
                          "FOR (c:Chunk) REQUIRE c.chunk_id IS UNIQUE;", "", *_section("CHUNK NODES")]),
        _lines(chunks, 1, F.col("chapter_number"), F.col("chunk_id"), 0, node),
        _fixed(spark, 2, ["", *_section("ARTICLE -> CHUNK RELATIONSHIPS")]),
        _lines(chunks, 3, F.col("chapter_number"), F.col("chunk_id"), 0, _edge(
            ("a", "Article", "article_id", "source_article_id"), chunk, F.lit(":HAS_CHUNK"))),
        _fixed(spark, 4, ["", *_section("CHUNK -> ENTITY RELATIONSHIPS")]),
        _lines(chunk_entities, 5, 0, F.col("chunk_id"), F.col("position"), _edge(
            chunk, ("e", "Entity", "entity_id", "entity_id"), F.lit(":MENTIONS_ENTITY"))),
    ])
