"""Three-tier chunking: a summary per article, sections, overlapping windows over long sections.

One article is one row and its sections are an array on it, so the whole job is a projection plus
two explodes: no shuffle unless a summary table is joined in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions import tokens as tok
from pageloom.functions.sql import once
from pageloom.functions.text import chunk_id, normalise, word_count

SUMMARY, SECTION, WINDOW = "article_summary", "section", "sliding_window"


@dataclass(frozen=True)
class ChunkParams:
    summary_max_tokens: int = 300
    section_min_tokens: int = 50
    window_threshold: int = 1500
    window_size: int = 512
    window_overlap: int = 64
    include_summaries: bool = True
    tokenizer: str = "word"

    def __post_init__(self) -> None:
        if self.window_overlap >= self.window_size:
            raise ValueError("window_overlap must be smaller than window_size")


def _measured(df: DataFrame, params: ChunkParams) -> DataFrame:
    """Token counts of the normalised sections and the first tokens of the article. Byte-pair tokens of both come
    from one worker."""
    norm, text = F.col("_norm"), F.col("markdown_content")
    if params.tokenizer == "bpe":
        df = df.withColumn("_m", tok.bpe_counts_and_lead(norm, text, params.summary_max_tokens))
        return df.withColumns({"_count": F.col("_m.counts"), "_lead": F.col("_m.lead")}).drop("_m")
    count = F.transform(norm, lambda t: tok.n_tokens(t, params.tokenizer))
    return df.withColumns({"_count": count, "_lead": tok.truncate(text, params.summary_max_tokens, params.tokenizer)})


def section_spans(articles: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """``articles`` plus ``_lead`` and ``spans``: the sections long enough to keep, each with its normalised text and
    approximate place in the article. The search starts after the previous kept section; skipped
    sections do not move the cursor."""
    df = articles.withColumn("_norm", F.transform("sections", lambda s: normalise(s["content"])))
    df = _measured(df, params)
    items = F.filter(
        once(F.col("_norm"), lambda norm: once(F.col("_count"), lambda n: F.transform(
            "sections",
            lambda s, i: F.struct(
                i.alias("section_index"), s["heading"].alias("heading"), s["content"].alias("raw"),
                F.get(norm, i).alias("text"), F.get(n, i).alias("token_count"),
            ),
        ))),
        lambda x: (x["text"] != "") & (x["token_count"] >= params.section_min_tokens),
    )
    df = df.withColumn("_items", items)
    cursor = "coalesce(try_element_at(acc, -1).char_end, 0)"
    places = F.expr(
        "aggregate(_items, cast(array() as array<struct<char_start:int,char_end:int>>), (acc, x) -> concat(acc, "
        f"transform(array(coalesce(nullif(locate(left(x.raw, 100), markdown_content, {cursor} + 1), 0) - 1, {cursor})), "
        "p -> named_struct('char_start', p, 'char_end', p + length(x.raw)))))"
    )
    df = df.withColumn("_places", places)
    spans = once(F.col("_places"), lambda places: F.transform(
        "_items",
        lambda x, i: F.struct(
            x["section_index"].alias("section_index"), x["heading"].alias("heading"), x["text"].alias("text"),
            x["token_count"].alias("token_count"), F.get(places, i)["char_start"].alias("char_start"),
            F.get(places, i)["char_end"].alias("char_end"),
        ),
    ))
    return df.withColumn("spans", spans).drop("_norm", "_count", "_items", "_places")


def route_tiers(spans: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """One row per chunk. Rows without a section (summaries) are one chunk each; without a token count they are
    counted here, in the worker that makes the windows."""
    is_long = F.col("token_count") > params.window_threshold
    is_window = is_long & F.col("section_index").isNotNull()
    text = F.col("text")
    uncounted = F.col("token_count").isNull()
    if params.tokenizer == "bpe":
        made = tok.bpe_windows(F.when(uncounted | is_window, text), params.window_size, params.window_overlap, uncounted)
        spans = spans.withColumn("_made", made)
        windows, many = F.col("_made"), is_window | uncounted
    else:
        spans = spans.withColumn("_tk", tok.tokens(F.when(is_window, text), params.tokenizer))
        windows, many = tok.windows_of(F.col("_tk"), params.window_size, params.window_overlap), is_window
    single = F.array(
        F.struct(
            F.lit(None).cast("int").alias("window"), text.alias("text"), F.col("token_count").alias("n"),
            F.lit(0).alias("start"), F.length(text).alias("end"),
        )
    )
    pieces = F.when(many, windows).otherwise(single)
    df = spans.withColumn("_w", F.explode_outer(pieces))
    windowed = F.col("_w.window").isNotNull()
    kind = F.when(F.col("section_index").isNull(), SUMMARY).when(windowed, WINDOW).otherwise(SECTION)
    df = df.withColumn("chunk_type", kind)
    return df.select(
        chunk_id(F.col("article_id"), F.col("chunk_type"), F.col("section_index"), F.col("_w.window")).alias("chunk_id"),
        "chunk_type", F.col("article_id").alias("source_article_id"),
        F.col("section_index").alias("source_section_index"), F.col("_w.window").alias("window_index"),
        F.col("_w.text").alias("text"),
        F.when(windowed, F.col("char_start") + F.col("_w.start")).otherwise(F.col("char_start")).alias("char_start"),
        F.when(windowed, F.col("char_start") + F.col("_w.end")).otherwise(F.col("char_end")).alias("char_end"),
        F.when(windowed, F.concat(F.col("heading"), F.lit(" (part "), (F.col("_w.window") + 1).cast("string"), F.lit(")")))
        .otherwise(F.col("heading")).alias("heading"),
        "chapter_number", F.col("title").alias("article_title"), F.col("_w.n").alias("token_count"),
        F.length("_w.text").cast("long").alias("char_count"), word_count(F.col("_w.text")).alias("word_count"),
    )


def with_summary(articles: DataFrame, enrichment: DataFrame | None) -> DataFrame:
    """Adds ``summary`` from the enrichment table (left join), null where there is none."""
    if enrichment is None:
        return articles.withColumn("summary", F.lit(None).cast("string"))
    return articles.drop("summary").join(enrichment.select("article_id", "summary"), "article_id", "left")


def chunk_articles(
    articles: DataFrame, enrichment: DataFrame | None = None, params: ChunkParams = ChunkParams()
) -> DataFrame:
    """``articles(article_id, chapter_number, title, markdown_content, sections)`` to chunk rows."""
    df = section_spans(with_summary(articles, enrichment), params)
    if params.include_summaries:
        df = df.withColumn("_s", normalise(F.coalesce(F.nullif(F.col("summary"), F.lit("")), F.col("_lead"))))
        late = F.lit(None).cast("long")
        df = df.withColumn("_n", late if params.tokenizer == "bpe" else tok.n_tokens(F.col("_s"), params.tokenizer))
        summary = F.struct(
            F.lit(None).cast("int").alias("section_index"), F.col("title").alias("heading"), F.col("_s").alias("text"),
            F.col("_n").alias("token_count"), F.lit(0).alias("char_start"), F.length("_s").alias("char_end"),
        )
        df = df.withColumn("spans", F.when(F.col("_s") == "", F.col("spans")).otherwise(
            F.concat(F.array(summary), F.col("spans"))))
    rows = df.select("article_id", "chapter_number", "title", F.inline_outer("spans")).filter("text is not null")
    return route_tiers(rows, params)


def with_entity_ids(chunks: DataFrame, chunk_entities: DataFrame) -> DataFrame:
    """Adds ``entity_ids`` (mention order, repeats kept) and ``entity_count``. A chunk's mentions are
    bounded by its text. A chunk id belongs to one article; where both tables name it, as those of ``link_mentions`` do,
    tables that are dealt by article meet without moving."""
    keys = [c for c in ("source_article_id", "chunk_id") if c in chunks.columns and c in chunk_entities.columns]
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("position", "end_pos", "entity_id"))), lambda x: x["entity_id"]
    )
    ids = chunk_entities.groupBy(*keys).agg(listed.alias("entity_ids"))
    df = chunks.join(ids, keys, "left").select(*chunks.columns, "entity_ids")
    df = df.withColumn("entity_ids", F.coalesce("entity_ids", F.array().cast("array<string>")))
    return df.withColumn("entity_count", F.size("entity_ids").cast("long"))


def chunk_stats(chunks: DataFrame, chunk_entities: DataFrame) -> DataFrame:
    """One row of counters."""
    own = chunks.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count_if(F.col("chunk_type") == SUMMARY).alias("summary_chunks"),
        F.count_if(F.col("chunk_type") == SECTION).alias("section_chunks"),
        F.count_if(F.col("chunk_type") == WINDOW).alias("sliding_window_chunks"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"),
        F.count_distinct("source_article_id").alias("articles_processed"),
    )
    links = chunk_entities.agg(F.count(F.lit(1)).alias("total_entities_linked"))
    return own.withColumn("_one", F.lit(1)).join(links.withColumn("_one", F.lit(1)), "_one").drop("_one")


def article_index(chunks: DataFrame) -> DataFrame:
    """Article to its chunk ids in reading order; bounded by the article."""
    order = F.struct(
        F.coalesce("source_section_index", F.lit(-1)).alias("s"), F.coalesce("window_index", F.lit(-1)).alias("w"), "chunk_id"
    )
    ids = F.transform(F.array_sort(F.collect_list(order)), lambda x: x["chunk_id"])
    return chunks.groupBy("source_article_id").agg(ids.alias("chunk_ids"))


def entity_index(chunk_entities: DataFrame) -> DataFrame:
    """Entity to chunk ids, one row per entity and article. A common entity is thus a list of rows,
    each bounded by an article, and never one group. ``links`` counts repeats."""
    return chunk_entities.groupBy("entity_id", "source_article_id").agg(
        F.array_sort(F.collect_set("chunk_id")).alias("chunk_ids"), F.count(F.lit(1)).alias("links")
    )
