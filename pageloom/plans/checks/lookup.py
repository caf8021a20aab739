"""Vectors, text search, lookups that mix both with the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import search as se
from pageloom.operators.ranked import build_index, ranked_top_k
from pageloom.operators import vectors as ve
from pageloom.operators.neighbours import approximate_top_k, build_vector_index
from pageloom.operators.mentions import link_mentions
from pageloom.plans import standins as st
from pageloom.plans.checks import register
from pageloom.plans.checks.ctes import sql
from pageloom.plans.checks.text import chunks, ints
from pageloom.session import dealt, written

DIMS = 64

#: Hashed word vectors of chunks and of the benchmark passages, as in ``embed_chunks``.
_VECTORS = rf"""
hashed AS (SELECT kind, id, ('0x' || substr(md5(w), 1, 7))::BIGINT % {DIMS} AS b, count(*) AS n FROM (
  SELECT 'c' AS kind, chunk_id AS id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w FROM chunk
  UNION ALL SELECT 'q', item_id::VARCHAR, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) FROM benchmark) GROUP BY ALL),
unit AS (SELECT h.kind, h.id, h.b, h.n / s.norm AS x FROM hashed h JOIN (SELECT kind, id, sqrt(sum(n * n)) AS norm FROM hashed GROUP BY ALL) s USING (kind, id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, chunk_id) AS rank FROM (
  SELECT c.id AS chunk_id, q.id::BIGINT AS query_id, round(sum(c.x * q.x), 6) + 0.0 AS similarity FROM unit c JOIN unit q ON c.kind = 'c' AND q.kind = 'q' AND c.b = q.b GROUP BY ALL)) WHERE rank <= 5)"""


def _with(body: str, *names: str) -> str:
    return sql("@", *names).replace("\n@", ",\n" + _VECTORS + "\n" + body)


def embedded(spark, sf):
    return ve.embed_chunks(chunks(spark, sf), DIMS)


def questions(spark, sf):
    q = st.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return ve.embed_chunks(q, DIMS, key="query_id").select("query_id", "embedding")


@register("embed_chunks", _with("SELECT id AS chunk_id, count(*) AS filled, round(sum(x), 6) AS total FROM unit WHERE kind = 'c' GROUP BY 1", "chunk"))
def embed_chunks(spark, sf):
    df = embedded(spark, sf).withColumn("total", F.expr("aggregate(embedding, 0D, (a, x) -> a + x)")).filter("total > 0")
    return df.select("chunk_id", F.expr("cast(size(filter(embedding, x -> x > 0)) as bigint)").alias("filled"), F.round("total", 6).alias("total"))


@register("chunk_cosine_top_k", _with("SELECT query_id, chunk_id AS id, round(similarity, 5) AS similarity, rank FROM best WHERE rank = 1", "chunk"))
def chunk_cosine_top_k(spark, sf):
    """Best chunk for every benchmark passage, over all chunks."""
    vectors = embedded(spark, sf).select(F.col("chunk_id").alias("id"), "embedding")
    best = ve.cosine_top_k(questions(spark, sf), vectors, k=1, digits=6)
    return best.select("query_id", "id", F.round("similarity", 5).alias("similarity"), F.col("rank").cast("long").alias("rank"))


_CENTRES = """
WITH part AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS x FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY 1, 2),
centre AS (SELECT label, list(x ORDER BY i) AS v FROM part GROUP BY 1)
SELECT query_id, id, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (
  SELECT c.label AS query_id, e.vec_id AS id, round(list_cosine_similarity(c.v, e.embedding::DOUBLE[]), 6) AS similarity FROM centre c, embeddings e)) WHERE rank <= 10"""


def _centres(spark, sf):
    e = st.table(spark, sf, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])
    return parts.groupBy("label").agg(ordered.alias("embedding")).withColumnRenamed("label", "query_id")


@register("cosine_top_k", _CENTRES)
def cosine_top_k(spark, sf):
    """Ten nearest vectors to the mean of each label."""
    vectors = st.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return ints(ve.cosine_top_k(_centres(spark, sf), vectors, k=10, digits=6), "rank")


@register("cosine_top_k_grid", _CENTRES)
def cosine_top_k_grid(spark, sf):
    """The same in several passes, as for query sets larger than one block."""
    vectors = st.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return ints(ve.cosine_top_k(_centres(spark, sf), vectors, k=10, max_broadcast=2, digits=6), "rank")


def _looked_up(spark, sf):
    """Every twentieth vector against all vectors: the questions and the index."""
    e = written(st.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), "vectors")
    return e.filter("id % 20 = 0").withColumnRenamed("id", "query_id"), e


@register("vector_index_top_k")
def vector_index_top_k(spark, sf):
    """Through the index; tests and ``vector_index_recall`` compare it with the exact answer."""
    queries, vectors = _looked_up(spark, sf)
    return ints(approximate_top_k(queries, build_vector_index(vectors), 10), "rank")


@register("vector_index_recall", """
SELECT count(*) AS indexed, count(*) FILTER (vec_id % 20 = 0) AS queries, true AS reached FROM embeddings
WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)""")
def vector_index_recall(spark, sf):
    """All sound vectors are in the index, and nine in ten of the exact ten nearest are found."""
    queries, vectors = _looked_up(spark, sf)
    index = build_vector_index(vectors)
    exact = ve.cosine_top_k(queries, vectors, 10).select("query_id", "id")
    found = written(approximate_top_k(queries, index, 10).select("query_id", "id", F.lit(1).alias("hit")), "found")
    share = exact.join(found, ["query_id", "id"], "left").agg(
        F.countDistinct("query_id").alias("queries"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("reached"))
    return index.lists.agg(F.count(F.lit(1)).alias("indexed")).join(share, F.lit(True))


@register("hybrid_lookup", _with("""
SELECT query_id, chunk_id, count(*) AS shared_entities FROM (SELECT DISTINCT query_id, entity_id FROM best JOIN link USING (chunk_id) WHERE rank = 1)
JOIN (SELECT DISTINCT chunk_id, entity_id FROM link) USING (entity_id) GROUP BY 1, 2""", "chunk", "link"))
def hybrid_lookup(spark, sf):
    df = dealt(chunks(spark, sf), "source_article_id")
    links = dealt(link_mentions(df, st.mentions(spark, sf)), "source_article_id")
    vectors = ve.embed_chunks(df, DIMS).select("chunk_id", "embedding")
    return ve.hybrid_lookup(questions(spark, sf), vectors, links, k=1, digits=6)


@register("attach_vectors", sql("""
SELECT c.chunk_id, v.vec_id FROM chunk c JOIN (SELECT vec_id, 'ch' || (vec_id % 15 + 1) || '-art' || (vec_id // 15) || '-summary' AS chunk_id FROM embeddings) v USING (chunk_id)""", "chunk"))
def attach_vectors(spark, sf):
    return ve.attach_vectors(chunks(spark, sf).select("chunk_id"), _document_vectors(spark, sf)).select("chunk_id", "vec_id")


def _document_vectors(spark, sf):
    n = F.col("vec_id")
    name = F.concat(F.lit("ch"), (n % 15 + 1).cast("string"), F.lit("-art"), F.floor(n / 15).cast("string"), F.lit("-summary"))
    return st.table(spark, sf, "embeddings").select("vec_id", name.alias("chunk_id"), "embedding")


@register("embedded_tokens", sql("""
SELECT sum(token_count)::BIGINT AS total_tokens_embedded FROM chunk WHERE chunk_id IN (
  SELECT 'ch' || (vec_id % 15 + 1) || '-art' || (vec_id // 15) || '-summary' FROM embeddings)""", "chunk"))
def embedded_tokens(spark, sf):
    return ve.embedded_tokens(chunks(spark, sf), _document_vectors(spark, sf))


@register("embedding_cost", sql("""
SELECT count(*) AS total_chunks, sum(token_count)::BIGINT AS total_tokens, 'text-embedding-3-small' AS model, round(sum(token_count) * 0.02 / 1e6, 9) AS estimated_cost_usd FROM chunk""", "chunk"))
def embedding_cost(spark, sf):
    return ve.embedding_cost(chunks(spark, sf)).withColumn("estimated_cost_usd", F.round("estimated_cost_usd", 9))


@register("vector_dimensions", "SELECT vec_id, len(embedding) AS dimensions FROM embeddings")
def vector_dimensions(spark, sf):
    return st.table(spark, sf, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("dimensions"))


@register("search_articles", sql("SELECT article_id, title, url, left(text, 500) AS excerpt FROM doc WHERE contains(lower(text), 'heron')", "doc"))
def search_articles(spark, sf):
    return se.search_articles(st.articles(spark, sf), "Heron")


@register("text_top_k", sql(r"""
SELECT query_id, article_id, score::BIGINT AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, article_id) AS rank FROM (
  SELECT query_id, article_id, count(*) AS score FROM (SELECT article_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM doc)
  JOIN (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM benchmark) USING (w) GROUP BY 1, 2)) WHERE rank <= 10""", "doc"))
def text_top_k(spark, sf):
    asked = st.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return ints(se.text_top_k(st.articles(spark, sf), asked, 10, "markdown_content"), "rank")


@register("ranked_text_top_k", sql(r"""
SELECT query_id, article_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, article_id) AS rank FROM (
  WITH c AS (SELECT article_id, w, count(*) AS n FROM (SELECT article_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM doc) GROUP BY 1, 2),
  len AS (SELECT article_id, sum(n) AS len FROM c GROUP BY 1), whole AS (SELECT count(*) AS texts, sum(len)::DOUBLE / count(*) AS average FROM len),
  df AS (SELECT w, count(*) AS df FROM c GROUP BY 1)
  SELECT query_id, article_id, sum(floor(1000 * (n * 2.2::DOUBLE) / (n + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / average)))::BIGINT
    * floor(1000 * ln(1 + (texts - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)))::BIGINT)::BIGINT AS score
  FROM c JOIN len USING (article_id) JOIN df USING (w) JOIN whole ON true
  JOIN (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM benchmark) USING (w)
  WHERE floor(1000 * ln(1 + (texts - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))) > 0 GROUP BY 1, 2)) WHERE rank <= 10""", "doc"))
def ranked_text_top_k(spark, sf):
    """Weighted by rarity and length, over an inverted index of all articles; blocks below the tenth score are passed over."""
    asked = st.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    index = build_index(st.articles(spark, sf), "article_id", "markdown_content")
    return ints(ranked_top_k(index, asked, 10).withColumnRenamed("id", "article_id"), "rank")
