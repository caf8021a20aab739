"""Totals per chapter, for the guide and for the enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chapter_rollup(articles: DataFrame) -> DataFrame:
    return articles.groupBy("chapter_number").agg(
        F.count(F.lit(1)).alias("article_count"), F.sum("word_count").alias("total_word_count")
    )


def guide_totals(articles: DataFrame, glossary: DataFrame) -> DataFrame:
    totals = articles.agg(
        F.count(F.lit(1)).alias("total_articles"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("total_word_count"),
        F.count_distinct("chapter_number").alias("total_chapters"), F.lit(1).alias("_one"),
    )
    terms = glossary.agg(F.count(F.lit(1)).alias("term_count"), F.lit(1).alias("_one"))
    return totals.join(terms, "_one").drop("_one").withColumn("includes_glossary", F.col("term_count") > 0)


def enrichment_counts(mentions: DataFrame, entities: DataFrame, relationships: DataFrame) -> DataFrame:
    """One row: mentions, their articles, unique entities and unique relationships. Ids are counted once each, so
    ``entities`` and ``relationships`` may be the rows before they are merged."""
    one = F.lit(1).alias("_one")
    m = mentions.agg(F.count(F.lit(1)).alias("mention_count"), F.count_distinct("article_id").alias("article_count"), one)
    e = entities.agg(F.count_distinct("entity_id").alias("entity_count"), one)
    r = relationships.agg(F.count_distinct("relationship_id").alias("relationship_count"), one)
    return m.join(e, "_one").join(r, "_one").drop("_one")


def article_enrichment_counts(mentions: DataFrame, relationships: DataFrame) -> DataFrame:
    """Entities and relationships per article."""
    m = mentions.groupBy(F.col("article_id").alias("source_article_id")).agg(F.count(F.lit(1)).alias("entity_count"))
    r = relationships.groupBy("source_article_id").agg(F.count(F.lit(1)).alias("relationship_count"))
    df = m.join(r, "source_article_id", "full_outer")
    return df.na.fill(0, ["entity_count", "relationship_count"])
