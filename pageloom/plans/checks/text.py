"""Text functions, tokens, windows and chunks over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import text as tx
from pageloom.functions import tokens as tok
from pageloom.operators import chunks as ch
from pageloom.plans import standins as st
from pageloom.plans.checks import register
from pageloom.plans.checks.ctes import sql


def ints(df, *columns):
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


@register("word_and_char_count", r"SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS words, length(text) AS chars FROM documents")
def word_and_char_count(spark, sf):
    return st.documents(spark, sf).select("doc_id", tx.word_count(F.col("text")).alias("words"), tx.char_count(F.col("text")).alias("chars"))


@register("normalise_text", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS norm FROM documents")
def normalise_text(spark, sf):
    return st.documents(spark, sf).select("doc_id", tx.normalise(F.col("text")).alias("norm"))


@register("truncate_to_tokens", r"""
SELECT doc_id, CASE WHEN len(tk) <= 300 THEN text ELSE array_to_string(tk[1:300], '') END AS lead, len(tk) AS tokens
FROM (SELECT doc_id, text, regexp_extract_all(text, '\s*\S+') AS tk FROM documents)""")
def truncate_to_tokens(spark, sf):
    t = F.col("text")
    return st.documents(spark, sf).select("doc_id", tok.truncate(t, 300).alias("lead"), tok.n_tokens(t).alias("tokens"))


@register("token_estimate", "SELECT doc_id, greatest(1, floor(length(text) / 4.0))::BIGINT AS tokens FROM documents")
def token_estimate(spark, sf):
    return st.documents(spark, sf).select("doc_id", tx.estimate_tokens(F.col("text")).alias("tokens"))


@register("token_windows", r"""
SELECT doc_id, i AS "window", array_to_string(tk[i * 448 + 1:i * 448 + 512], '') AS text, len(tk[i * 448 + 1:i * 448 + 512]) AS token_count,
  length(coalesce(array_to_string(tk[1:i * 448], ''), '')) AS "start",
  length(coalesce(array_to_string(tk[1:i * 448], ''), '')) + length(array_to_string(tk[i * 448 + 1:i * 448 + 512], '')) AS "end"
FROM (SELECT doc_id, tk, unnest(range(CASE WHEN len(tk) <= 512 THEN 1 ELSE ceil((len(tk) - 512) / 448.0)::BIGINT + 1 END)) AS i FROM (
  SELECT doc_id, regexp_extract_all(trim(regexp_replace(text, '\s+', ' ', 'g')), '\s*\S+') AS tk FROM documents) WHERE len(tk) > 0)""")
def token_windows(spark, sf):
    df = st.documents(spark, sf).select("doc_id", tx.normalise(F.col("text")).alias("text"))
    return ints(tok.token_windows(df, "text"), "window", "start", "end")


@register("token_windows_bpe")
def token_windows_bpe(spark, sf):
    df = st.documents(spark, sf).select("doc_id", tx.normalise(F.col("text")).alias("text"))
    return ints(tok.token_windows(df, "text", tokenizer="bpe"), "window", "start", "end")


@register("entity_ids", r"""
SELECT doc_id, 'concept-' || substr(md5(regexp_replace(lower(left(text, 40)), '^\s+|\s+$', '', 'g')), 1, 8) AS entity_id,
  'rel-' || substr(md5(lang || '-USED_BY-' || source), 1, 12) AS relationship_id FROM documents""")
def entity_ids(spark, sf):
    df = st.table(spark, sf, "documents")
    return df.select(
        "doc_id", tx.entity_id(F.lit("concept"), tx.cap(F.col("text"), 40)).alias("entity_id"),
        tx.relationship_id(F.col("lang"), F.lit("USED_BY"), F.col("source")).alias("relationship_id"))


@register("text_caps", """
SELECT doc_id, left(text, 500) AS c500, left(text, 200) AS c200, left(text, 8000) AS c8000,
  regexp_replace(left(text, 200), '^\\s+|\\s+$', '', 'g') || '...' AS lead FROM documents""".replace("\\\\", "\\"))
def text_caps(spark, sf):
    t = F.col("text")
    return st.documents(spark, sf).select(
        "doc_id", tx.cap(t, 500).alias("c500"), tx.cap(t, 200).alias("c200"), tx.cap(t, 8000).alias("c8000"),
        tx.lead_summary(t).alias("lead"))


@register("escaped_text", r"""
SELECT doc_id, replace(replace(replace(text, '\', '\\'), '''', '\'''), chr(10), ' ') AS node_text,
  replace(replace(replace(text, '\', '\\'), '''', '\'''), chr(10), '\n') AS chunk_text FROM documents""")
def escaped_text(spark, sf):
    t = F.col("text")
    return st.documents(spark, sf).select("doc_id", tx.escape(t).alias("node_text"), tx.escape(t, "\\n").alias("chunk_text"))


@register("json_text", "SELECT doc_id, to_json({'doc_id': doc_id, 'text': text, 'lang': lang})::VARCHAR AS record FROM documents")
def json_text(spark, sf):
    return st.table(spark, sf, "documents").select("doc_id", F.to_json(F.struct("doc_id", "text", "lang")).alias("record"))


@register("chapter_of_article", sql("SELECT article_id, regexp_extract(article_id, '^ch(\\d+)', 1)::BIGINT AS chapter FROM doc".replace("\\\\", "\\"), "doc"))
def chapter_of_article(spark, sf):
    return st.articles(spark, sf).select("article_id", tx.chapter_of(F.col("article_id")).cast("long").alias("chapter"))


@register("section_places", sql("SELECT article_id, section_index, char_start, char_end FROM span", "span"))
def section_places(spark, sf):
    df = ch.section_spans(st.articles(spark, sf), st.PARAMS).select("article_id", F.inline_outer("spans")).filter("text is not null")
    return ints(df.select("article_id", "section_index", "char_start", "char_end"), "section_index", "char_start", "char_end")


@register("short_sections", sql("""
SELECT count(*) AS sections, count(*) FILTER (norm = '') AS empty_sections, count(*) FILTER (norm <> '' AND n < 50) AS short_sections,
  count(*) FILTER (norm <> '' AND n BETWEEN 50 AND 200) AS single_sections, count(*) FILTER (norm <> '' AND n > 200) AS windowed_sections FROM sec""", "sec"))
def short_sections(spark, sf):
    s = st.articles(spark, sf).select(F.explode("sections").alias("s")).select(tx.normalise(F.col("s.content")).alias("norm"))
    s = s.select("norm", tok.n_tokens(F.col("norm")).alias("n"))
    full = F.col("norm") != ""
    p = st.PARAMS
    return s.agg(
        F.count(F.lit(1)).alias("sections"), F.count_if(~full).alias("empty_sections"),
        F.count_if(full & (F.col("n") < p.section_min_tokens)).alias("short_sections"),
        F.count_if(full & F.col("n").between(p.section_min_tokens, p.window_threshold)).alias("single_sections"),
        F.count_if(full & (F.col("n") > p.window_threshold)).alias("windowed_sections"))


CHUNK_SQL = """SELECT chunk_id, chunk_type, source_article_id, source_section_index, text, char_start, char_end, heading, chapter_number,
  article_title, token_count, char_count, word_count FROM chunk"""


def chunks(spark, sf):
    return ch.chunk_articles(st.articles(spark, sf), None, st.PARAMS)


@register("chunk_articles", sql(CHUNK_SQL, "chunk"))
def chunk_articles(spark, sf):
    return ints(chunks(spark, sf).drop("window_index"), "source_section_index", "char_start", "char_end", "chapter_number")


@register("chunk_articles_with_summaries", sql(r"""
SELECT article_id, trim(regexp_replace(CASE WHEN lang = 'en' AND string_split(text, chr(10))[1] <> '' THEN string_split(text, chr(10))[1]
  ELSE array_to_string(regexp_extract_all(text, '\s*\S+')[1:300], '') END, '\s+', ' ', 'g')) AS text FROM doc""", "doc"))
def chunk_articles_with_summaries(spark, sf):
    df = ch.chunk_articles(st.articles(spark, sf), st.enrichment(spark, sf), st.PARAMS)
    return df.filter(F.col("chunk_type") == ch.SUMMARY).select(F.col("source_article_id").alias("article_id"), "text")


@register("chunk_articles_bpe")
def chunk_articles_bpe(spark, sf):
    params = ch.ChunkParams(section_min_tokens=50, window_threshold=200, window_size=64, window_overlap=8, tokenizer="bpe")
    return ch.chunk_articles(st.articles(spark, sf), None, params)


@register("article_chunk_index", sql("""
SELECT source_article_id, string_agg(chunk_id, '|' ORDER BY coalesce(source_section_index, -1), coalesce(window_index, -1)) AS chunk_ids
FROM chunk GROUP BY 1""", "chunk"))
def article_chunk_index(spark, sf):
    return ch.article_index(chunks(spark, sf)).select("source_article_id", F.array_join("chunk_ids", "|").alias("chunk_ids"))


@register("chunk_jsonl", sql("""
SELECT chunk_id, to_json({'chunk_id': chunk_id, 'chunk_type': chunk_type, 'source_article_id': source_article_id,
  'source_section_index': source_section_index, 'text': text, 'char_start': char_start, 'char_end': char_end, 'entity_ids': coalesce(ids, []),
  'heading': heading, 'chapter_number': chapter_number, 'article_title': article_title, 'token_count': token_count, 'word_count': word_count,
  'entity_count': len(coalesce(ids, []))})::VARCHAR AS record
FROM chunk LEFT JOIN (SELECT chunk_id, list(entity_id ORDER BY position, end_pos, entity_id) AS ids FROM link GROUP BY 1) USING (chunk_id)""", "chunk", "link"))
def chunk_jsonl(spark, sf):
    from pageloom.plans.checks.graph import chunks_with_entities
    from pageloom.sources.writers import CHUNK_FIELDS

    df = chunks_with_entities(spark, sf)
    return df.select("chunk_id", F.to_json(F.struct(*CHUNK_FIELDS), {"ignoreNullFields": "false"}).alias("record"))
