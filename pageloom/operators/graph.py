"""Property graph as one table per node label and edge tables ``(src, dst, type, ...)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import cap, type_label
from pageloom.operators.keyed import last_filled_per_key, last_per_key


# ---- node tables ---------------------------------------------------------------------------------


def chapter_nodes(chapters: DataFrame) -> DataFrame:
    return chapters.select("chapter_number", "title", F.col("overview_url").alias("url"), F.lit("Chapter").alias("label"))


def article_nodes(articles: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Summary from the enrichment row where the article has one, else the article's own, else empty."""
    extra = enrichment.select("article_id", F.col("summary").alias("_summary"), F.lit(True).alias("_has"))
    own = articles["summary"] if "summary" in articles.columns else F.lit(None).cast("string")
    df = articles.withColumn("_own", own).drop("summary").join(extra, "article_id", "left")
    summary = F.when(F.col("_has"), F.coalesce("_summary", F.lit(""))).otherwise(F.coalesce("_own", F.lit("")))
    return df.select(
        "article_id", "title", "url", cap(summary, 500).alias("summary"), "word_count", "chapter_number",
        F.lit("Article").alias("label"),
    )


def entity_nodes(entities: DataFrame) -> DataFrame:
    def attribute(key):
        return F.coalesce(F.try_element_at("attributes", F.lit(key)), F.lit("")).alias(key)

    return entities.select(
        "entity_id", "name", "entity_type", cap(F.col("source_text"), 200).alias("source_text"), "source_article_id",
        "confidence", *[attribute(k) for k in ("definition", "vendor", "organization", "impact", "benefit")],
        F.concat(F.lit("Entity;"), type_label(F.col("entity_type"))).alias("label"),
    )


def glossary_nodes(glossary: DataFrame) -> DataFrame:
    return glossary.select("term", cap(F.col("definition"), 500).alias("definition"), F.lit("GlossaryTerm").alias("label"))


def chunk_nodes(chunks: DataFrame) -> DataFrame:
    """Expects ``entity_count`` on the chunks."""
    return chunks.select(
        "chunk_id", "chunk_type", "source_article_id", F.coalesce("heading", F.lit("")).alias("heading"),
        F.coalesce("chapter_number", F.lit(0)).alias("chapter_number"), "token_count", "word_count", "char_start",
        "char_end", "entity_count", F.lit("Chunk").alias("label"),
    )


# ---- edge tables ---------------------------------------------------------------------------------


def contains_edges(articles: DataFrame) -> DataFrame:
    return articles.select(
        F.col("chapter_number").cast("string").alias("src"), F.col("article_id").alias("dst"), F.lit("CONTAINS").alias("type")
    )


def mentions_edges(mentions: DataFrame) -> DataFrame:
    """One edge per mention; repeats stay."""
    return mentions.select(
        F.col("article_id").alias("src"), F.col("entity_id").alias("dst"), "confidence", F.lit("MENTIONS").alias("type")
    )


def semantic_edges(relationships: DataFrame) -> DataFrame:
    return relationships.select(
        F.col("source_entity_id").alias("src"), F.col("target_entity_id").alias("dst"), "confidence",
        cap(F.coalesce("source_text", F.lit("")), 200).alias("evidence"), F.col("relationship_type").alias("type"),
    )


def article_chunk_edges(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("source_article_id").alias("src"), F.col("chunk_id").alias("dst"), F.lit("HAS_CHUNK").alias("type"))


def chunk_entity_edges(chunk_entities: DataFrame, *carried: str) -> DataFrame:
    return chunk_entities.select(F.col("chunk_id").alias("src"), F.col("entity_id").alias("dst"), F.lit("MENTIONS_ENTITY").alias("type"), *carried)


def related_term_edges(enriched_glossary: DataFrame) -> DataFrame:
    return enriched_glossary.select(
        F.col("term").alias("src"), F.explode("related_terms").alias("dst"), F.lit("RELATED_TERM").alias("type")
    )


# ---- loading rules -------------------------------------------------------------------------------


def upsert_nodes(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Later rows replace earlier ones of the same key."""
    return last_per_key(df, [key], order)


def upsert_entities(df: DataFrame, order: list[str]) -> DataFrame:
    """Later rows replace earlier ones property by property; empty values never overwrite."""
    return last_filled_per_key(df, ["entity_id"], order, [c for c in df.columns if c not in ("entity_id", *order)])


def endpoints(nodes: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct node ids of all labels as text."""
    ids = [df.select(F.col(key).cast("string").alias("id")) for df, key in nodes]
    return reduce(DataFrame.unionByName, ids).distinct()


def attached_edges(edges: DataFrame, src_ids: DataFrame, dst_ids: DataFrame) -> DataFrame:
    """Edges whose two nodes exist."""
    out = edges.join(src_ids.select(F.col("id").alias("src")), "src", "left_semi")
    return out.join(dst_ids.select(F.col("id").alias("dst")), "dst", "left_semi")


def dangling_edges(edges: DataFrame, src_ids: DataFrame, dst_ids: DataFrame) -> DataFrame:
    """The other edges, with the end that is missing."""
    s = src_ids.select(F.col("id").alias("src")).distinct().withColumn("_s", F.lit(True))
    d = dst_ids.select(F.col("id").alias("dst")).distinct().withColumn("_d", F.lit(True))
    df = edges.join(s, "src", "left").join(d, "dst", "left").filter("_s is null or _d is null")
    missing = F.when(F.col("_s").isNull() & F.col("_d").isNull(), "both").when(F.col("_s").isNull(), "src").otherwise("dst")
    return df.withColumn("missing", missing).drop("_s", "_d")


def upsert_edges(edges: DataFrame, src_ids: DataFrame, dst_ids: DataFrame, order: list[str]) -> DataFrame:
    """Attached edges, one per ``(src, dst, type)``, the last row's properties winning."""
    return last_per_key(attached_edges(edges, src_ids, dst_ids), ["src", "dst", "type"], order)


def edges_of(edges: DataFrame, node_id: str) -> DataFrame:
    return edges.filter((F.col("src") == node_id) | (F.col("dst") == node_id))


def degrees(edges: DataFrame) -> DataFrame:
    """In and out edges per node."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("node_id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )).alias("e"))
    return ends.groupBy("e.node_id").agg(F.sum("e.o").alias("out_edges"), F.sum("e.i").alias("in_edges"))


def load_counts(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows sent and rows kept after upsert, per label or edge type. Keys of a table that is ``dealt`` by one of them are
    counted where they are; a column that the other keys determine may be among them for that."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("sent"), F.count_distinct(*keys).alias("kept")).select(
            F.lit(name).alias("label"), "sent", "kept"
        )
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def build_graph(
    nodes: dict[str, tuple[DataFrame, str, list[str]]],
    edges: dict[str, tuple[DataFrame, str, str, list[str]]],
    mode: str = "upsert",
) -> dict[str, DataFrame]:
    """``nodes``: label to (table, key, order); ``edges``: name to (table, source label, target label,
    order). ``upsert`` applies the loading rules, ``multiset`` keeps every row."""
    if mode == "multiset":
        return {name: spec[0] for name, spec in {**nodes, **edges}.items()}
    if mode != "upsert":
        raise ValueError(f"unknown mode {mode}")
    out = {
        label: upsert_entities(df, order) if label == "Entity" else upsert_nodes(df, key, order)
        for label, (df, key, order) in nodes.items()
    }
    for name, (df, src, dst, order) in edges.items():
        ids = [endpoints([(nodes[label][0], nodes[label][1])]) for label in (src, dst)]
        out[name] = upsert_edges(df, *ids, order)
    return out
