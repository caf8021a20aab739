"""Embedding chunks, attaching vectors, cosine top-k and the lookup that mixes vectors and graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import light, shared_path, written

# Price per million tokens and vector width by model.
PRICE_PER_MILLION = {"text-embedding-3-small": 0.02, "text-embedding-3-large": 0.13}
DIMENSIONS = {"text-embedding-3-small": 1536, "text-embedding-3-large": 3072}

#: Bytes of query vectors that one pass over the vectors hands to every task.
PASS_BYTES = 32 << 20
#: Bytes of products of queries and vectors that a worker holds at a time.
PRODUCT_BYTES = 8 << 20


def hashed_words(batches: Iterator[pd.DataFrame], dims: int) -> Iterator[pd.DataFrame]:
    """Unit vectors of word counts; ``buckets`` holds each word's place."""
    for pdf in batches:
        sizes = pdf["buckets"].map(len).to_numpy()
        rows = np.repeat(np.arange(len(pdf)), sizes)
        places = np.concatenate([np.asarray(b, dtype=np.int64) for b in pdf["buckets"]]) if len(rows) else rows
        counts = np.zeros((len(pdf), dims))
        np.add.at(counts, (rows, places), 1.0)
        norms = np.linalg.norm(counts, axis=1, keepdims=True)
        vectors = counts / np.where(norms == 0, 1.0, norms)
        yield pd.DataFrame({"id": pdf["id"], "embedding": list(vectors)})


def word_buckets(text: str, dims: int):
    """Place of each lower-cased word: the first seven hex digits of its md5, modulo the width."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return F.transform(
        words, lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int"), F.lit(dims))
    )


def embed_chunks(
    chunks: DataFrame, dims: int = 64, model_id: str = "hashed-words",
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
    key: str = "chunk_id", text: str = "text",
) -> DataFrame:
    """``(key, embedding, model_id, dimensions)``. ``fn`` gets batches of ``(id, text)`` and yields
    ``(id, embedding)`` in any order; the default hashes words and needs no model. Batch size is
    Spark's Arrow batch size."""
    ddl = f"id {chunks.schema[key].dataType.simpleString()}, embedding array<double>"
    if fn is None:
        batch = chunks.select(F.col(key).alias("id"), word_buckets(text, dims).alias("buckets"))
        vectors = batch.mapInPandas(lambda it: hashed_words(it, dims), ddl)
    else:
        vectors = chunks.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInPandas(fn, ddl)
    return vectors.select(
        F.col("id").alias(key), "embedding", F.lit(model_id).alias("model_id"), F.size("embedding").alias("dimensions")
    )


def attach_vectors(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunks that have a vector; vectors without a chunk are ignored."""
    return chunks.join(embeddings, "chunk_id")


def embedded_tokens(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Tokens of the embedded chunks that still exist."""
    return chunks.join(embeddings.select("chunk_id"), "chunk_id", "left_semi").agg(
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens_embedded")
    )


def embedding_cost(chunks: DataFrame, model_id: str = "text-embedding-3-small") -> DataFrame:
    """Cost estimate; unknown models are free."""
    price = PRICE_PER_MILLION.get(model_id, 0.0) / 1_000_000
    return chunks.agg(
        F.count(F.lit(1)).alias("total_chunks"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens")
    ).select("*", F.lit(model_id).alias("model"), (F.col("total_tokens") * F.lit(price)).alias("estimated_cost_usd"))


def products(left: np.ndarray, right: np.ndarray, most: int = PRODUCT_BYTES) -> Iterator[tuple[int, np.ndarray]]:
    """``left @ right.T`` in runs of rows of at most ``most`` bytes (one row at least), each with its first row."""
    step = max(1, most // (8 * max(1, len(right))))
    for at in range(0, len(left), step):
        yield at, left[at : at + step] @ right.T


def _matrix(vectors) -> np.ndarray:
    m = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, digits: int | None) -> pd.DataFrame:
    """Top k per query within one batch: similarity down, id up. Each row is cut a little below its k-th value;
    what stays is summed anew pair by pair, so that a similarity does not depend on the shape of its block.
    Products are made for a run of queries at a time, so memory does not grow with queries times vectors."""
    margin = 1e-9 if digits is None else 10.0**-digits + 1e-9
    found, sims = [], []
    for query, row in ((queries[at + i], row) for at, part in products(queries, vectors) for i, row in enumerate(part)):
        places = np.arange(len(row))
        if len(row) > k:
            places = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k] - margin)
        exact = np.einsum("ij,j->i", vectors[places], query)
        if digits is not None:
            exact = np.round(exact, digits) + 0.0
        order = np.lexsort((ids[places], -exact))[:k]
        found.append(places[order])
        sims.append(exact[order])
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    return pd.DataFrame({"query_id": query_ids[rows], "id": ids[np.concatenate(found)], "similarity": np.concatenate(sims)})


def cosine_top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 10, max_broadcast: int | None = None, digits: int | None = None
) -> DataFrame:
    """``queries(query_id, embedding)`` against ``vectors(id, embedding)``: exact top ``k`` per query.

    Null vectors on either side take no part. Ranks follow the full precision unless ``digits`` says to
    round similarities first, which makes ties of near values a matter of the id.

    Queries are written once and cut into blocks of ``PASS_BYTES`` (or ``max_broadcast`` rows). Each block
    is one pass over the vectors, which never shuffle: a batch is multiplied with the block and sends on
    its own top k, so at most k rows per query and batch are shuffled. A pass leaves its top k in the shared
    folder and gives its block back before the next one starts."""
    spark = queries.sparkSession
    ddl = (
        f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
        f"id {vectors.schema['id'].dataType.simpleString()}, similarity double"
    )
    asked = queries.filter("embedding is not null").select("query_id", "embedding")
    asked = written(asked.withColumn("_n", F.monotonically_increasing_id()), "queries")
    seen = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    if not seen["n"]:
        return spark.createDataFrame([], ddl + ", rank int")
    most = max_broadcast or max(1, PASS_BYTES // (8 * max(1, seen["width"])))
    passes = -(-seen["n"] // most)
    path = shared_path(spark, "top")
    rows = vectors.select("id", "embedding").filter("embedding is not null")
    for i in range(passes):
        block = asked.filter(F.pmod("_n", F.lit(passes)) == i).toPandas()
        if len(block):
            shared = spark.sparkContext.broadcast((block["query_id"].to_numpy(), _matrix(block["embedding"])))
            _ranked(rows.mapInPandas(_scan(shared, k, digits), ddl), k).drop("rank").write.mode("append").parquet(path)
            shared.destroy()
    return _ranked(spark.read.schema(ddl).parquet(path), k)


def _scan(shared, k: int, digits: int | None):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, matrix = shared.value
        for pdf in batches:
            if len(pdf):
                yield _best(query_ids, matrix, pdf["id"].to_numpy(), _matrix(pdf["embedding"]), k, digits)

    return scan


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hybrid_lookup(queries: DataFrame, vectors: DataFrame, chunk_entities: DataFrame, k: int = 10, digits: int | None = None) -> DataFrame:
    """Top-k chunks per query, their entities, and every chunk of those entities:
    ``(query_id, chunk_id, shared_entities)``.

    The hits and their entities are written and go to all tasks if they are ``light``. A chunk belongs to one article; where
    ``chunk_entities`` names it as ``source_article_id`` and is ``dealt`` by it, no link moves."""
    own = [c for c in ("source_article_id", "chunk_id") if c in chunk_entities.columns]
    hits = cosine_top_k(queries, vectors.withColumnRenamed("chunk_id", "id"), k, digits=digits).select(
        "query_id", F.col("id").alias("chunk_id")
    )
    links = chunk_entities.select(*own, "entity_id").distinct()
    found = chunk_entities.select("chunk_id", "entity_id").join(light(written(hits, "hits")), "chunk_id")
    entities = light(written(found.select("query_id", "entity_id").distinct(), "entities"))
    return links.join(entities, "entity_id").groupBy("query_id", *own).agg(
        F.count(F.lit(1)).alias("shared_entities")
    ).select("query_id", "chunk_id", "shared_entities")
