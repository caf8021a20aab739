"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors of integers lie in blocks of a range of ids, each a small forward index with the least and largest
value of every component. For a query, a component's share of the score in a block is at most its weight
times one of these; their sum bounds the block. A query takes the blocks in order of this bound, scores
them whole, and stops when the bound falls below its k-th score so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import written

#: Vectors in a block; in a stretch of blocks, which is searched by one task at a time; in a batch of queries.
BLOCK = 256
STRETCH = 4096
BATCH = 512


def scaled(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)`` with ``floor(scale * x)`` of each component x, as double; one row for each id.

    Rows without id, and vectors that are null, empty or hold null or non-finite components take no part.
    Of rows that share an id the smallest vector counts."""
    limit = float("inf")
    v = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v"))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _packed(size: int):
    """Rows ``(id, v)`` in order of id to rows ``(dim, first, ids, values)`` of up to ``size`` vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def row(dim: int) -> pa.RecordBatch:
            ids = np.array([i for i, _ in held[dim]], np.int64)
            values = np.stack([v for _, v in held.pop(dim)])
            return pa.RecordBatch.from_arrays(
                [pa.array([dim]), pa.array(ids[:1]), pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                ["dim", "first", "ids", "vals"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = np.asarray(v.values, np.float64)
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == size:
                    yield row(len(v))
        for dim in list(held):
            yield row(dim)

    return pack


PACKED = "dim long, first long, ids binary, vals binary"


def _matrix(ids: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(values, np.float64).reshape(len(ids), -1)


def inner(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer inner products, queries by rows.

    Doubles are exact up to 2**53; beyond, Python integers are used, held within the range of a long."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    if most < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in rows], object), np.array([[int(x) for x in q] for q in queries], object)
    return np.clip(np.dot(whole[1], whole[0].T), -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score and then by smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= cut)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


class Forward:
    """The blocks of one stretch of the table."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.blocks = [(ids[a : a + BLOCK], values[a : a + BLOCK]) for a in range(0, len(ids), BLOCK)]
        self.least = np.stack([v.min(0) for _, v in self.blocks])
        self.most = np.stack([v.max(0) for _, v in self.blocks])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each query's place, and the ids and scores of its k best rows here."""
        bounds = np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T
        bounds += np.abs(bounds) * 1e-9 + 1  # room for rounding
        order = np.argsort(-bounds, axis=1, kind="stable")
        for q in range(len(queries)):
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for b in order[q].tolist():
                if len(ids) == k and bounds[q, b] < scores[-1]:
                    break
                block_ids, rows = self.blocks[b]
                got = inner(rows, queries[q : q + 1])[0]
                take = block_ids != query_ids[q]
                if len(ids) == k:
                    take &= got >= scores[-1]
                ids, scores = np.concatenate([ids, block_ids[take]]), np.concatenate([scores, got[take]])
                best = _best(scores, ids, k)
                ids, scores = ids[best], scores[best]
            yield q, ids, scores


def _search(k: int):
    """Rows ``(ids, vals, row_ids, row_vals)`` of a batch and a stretch to ``(query_id, vec_id, score)``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, vals, row_ids, row_vals = (batch.column(c)[i].as_py() for c in range(4))
                query_ids, queries = _matrix(ids, vals)
                out = [(np.full(len(best), query_ids[q]), best, scores)
                       for q, best, scores in Forward(*_matrix(row_ids, row_vals)).search(query_ids, queries, k)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], ["query_id", "vec_id", "score"])

    return search


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` the k rows of ``vectors`` with the
    largest inner product of components ``floor(scale * x)``; ties go to the smaller id, all if fewer.

    Both tables have the id and vector columns; other columns are not read. Rows with a null id and vectors
    that are null, empty or hold null or non-finite components take no part; of rows that share an id the
    smallest vector counts. A row with the query's id is never its result, nor is one whose length differs
    from the query's. Empty tables give an empty result. Scores beyond a long are held at its bounds.

    The table is laid out once in stretches of blocks by ranges of ids. Every batch of queries is sent to
    every stretch of its length; a meeting holds 4,096 rows and 512 queries, and returns k rows for each
    query, which are limited once more before the last shuffle."""
    rows = scaled(vectors, scale, id_col, vector_col).repartitionByRange("id").sortWithinPartitions("id")
    stretches = written(rows.mapInArrow(_packed(STRETCH), PACKED), "stretches")
    asked = scaled(queries, scale, id_col, vector_col).repartitionByRange("id").sortWithinPartitions("id")
    batches = written(asked.mapInArrow(_packed(BATCH), PACKED), "batches")

    # one small row for each stretch: its number among those of its length
    numbers = stretches.select("dim", "first").withColumn("number", F.row_number().over(Window.partitionBy("dim").orderBy("first")))
    counts = stretches.groupBy("dim").agg(F.count(F.lit(1)).alias("of"))
    sent = batches.join(counts, "dim").select("dim", "ids", "vals", F.explode(F.expr("sequence(1, cast(of as int))")).alias("number"))
    held = stretches.join(numbers, ["dim", "first"]).select("dim", "number", F.col("ids").alias("row_ids"), F.col("vals").alias("row_vals"))
    met = sent.join(held, ["dim", "number"]).select("ids", "vals", "row_ids", "row_vals")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
