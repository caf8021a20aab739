"""Approximate cosine lookup: an index table of lists around fitted centres.

The caller chooses between this and the exact ``cosine_top_k``. Centres and the number of lists that a
query reads come from a bounded sample; every vector is in the index. Similarities are exact, so only
neighbours in lists that were not read can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.vectors import _best, _matrix, _ranked, products
from pageloom.session import shared_path, written

#: Bytes of the sample that centres are fitted on, and of the vectors or queries that one task compares at a time.
SAMPLE_BYTES, BLOCK_BYTES = 16 << 20, 8 << 20
MOST_CELLS = 4096
#: Sampled vectors that are looked up in the sample to choose the number of lists to read.
TRIALS = 256


@dataclass(frozen=True)
class VectorIndex:
    """``lists(id, embedding, _n, cell)`` in files by ``cell``, the centres, the lists a query reads and the
    recall that the sample had with as many."""

    lists: DataFrame
    centres: np.ndarray
    probes: int
    sampled_recall: float

    def save(self, path: str) -> None:
        """Copy the index to a folder that outlives the session."""
        spark = self.lists.sparkSession
        self.lists.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/lists")
        rows = [(i, c.tolist(), self.probes, self.sampled_recall) for i, c in enumerate(self.centres)]
        spark.createDataFrame(rows, "cell int, centre array<double>, probes int, recall double").write.parquet(f"{path}/centres")

    @staticmethod
    def load(spark: SparkSession, path: str) -> VectorIndex:
        rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
        centres = np.array([r.centre for r in rows], dtype=np.float64)
        lists = spark.read.parquet(f"{path}/lists")
        return VectorIndex(lists, centres, rows[0].probes if rows else 1, rows[0].recall if rows else 1.0)


def _whole(df: DataFrame) -> DataFrame:
    """Rows whose vector is there and has only finite numbers."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound)


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and the similarity to it; products are made in runs of rows."""
    own, sims = np.empty(len(rows), np.int64), np.empty(len(rows))
    for at, part in products(rows, centres):
        own[at : at + len(part)] = part.argmax(axis=1)
        sims[at : at + len(part)] = part.max(axis=1)
    return own, sims


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centres by rounds of assignment and mean; a centre without members moves to the row that is
    farthest from its own."""
    centres = sample[np.random.default_rng(7).permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        own, sims = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centres)) == 0)
        sums[empty] = sample[np.argsort(sims, kind="stable")[: len(empty)]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms == 0, centres, sums / np.where(norms == 0, 1.0, norms))
    return centres


def choose_probes(sample: np.ndarray, centres: np.ndarray, recall: float, k: int) -> tuple[int, float]:
    """Fewest lists, nearest centres first, that hold this share of the k nearest sampled neighbours."""
    asked = sample[:TRIALS]
    sims = asked @ sample.T
    sims[np.arange(len(asked)), np.arange(len(asked))] = -2.0
    near = np.argsort(-sims, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.take_along_axis(place, nearest(sample, centres)[0][near], axis=1).ravel()
    if not len(needed):
        return len(centres), 1.0
    reached = np.cumsum(np.bincount(needed, minlength=len(centres))) / len(needed)
    probes = int(np.flatnonzero(reached >= recall)[0]) + 1 if (reached >= recall).any() else len(centres)
    return probes, float(reached[probes - 1])


def build_vector_index(
    vectors: DataFrame, cells: int | None = None, recall: float = 0.95, k: int = 10, sample_bytes: int = SAMPLE_BYTES
) -> VectorIndex:
    """Index of ``vectors(id, embedding)``.

    Vectors that are null, empty or hold null or non-finite entries, and vectors narrower than the widest,
    take no part; vectors of zeros have similarity 0 to all. Repeated ids and vectors stay as they are.
    Other columns are left out. ``cells`` is by default the root of the number of vectors, at most 4,096 and
    a quarter of the sample. The sample is the ``sample_bytes`` of vectors whose ids have the smallest hashes.
    One pass assigns all vectors and writes them by list; Spark splits large lists over several tasks."""
    spark = vectors.sparkSession
    rows = _whole(vectors.select("id", F.col("embedding").cast("array<double>").alias("embedding")))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    width = seen["width"] or 1
    rows = rows.filter(F.size("embedding") == width)
    most = max(1, sample_bytes // (8 * width))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(most).toPandas()
    sample = _matrix(picked["embedding"]) if len(picked) else np.zeros((1, width))
    wanted = cells or min(MOST_CELLS, -(-len(sample) // 4), max(1, round(seen["n"] ** 0.5)))
    centres = fit_centres(sample, min(wanted, len(sample)))
    probes, reached = choose_probes(sample, centres, recall, k)
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=nearest(_matrix(pdf["embedding"]), shared.value)[0].astype(np.int32))

    numbered = rows.withColumn("_n", F.monotonically_increasing_id())
    ddl = f"id {rows.schema['id'].dataType.simpleString()}, embedding array<double>, _n long, cell int"
    path = shared_path(spark, "lists")
    numbered.mapInPandas(assign, ddl).hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    return VectorIndex(spark.read.schema(ddl).parquet(path), centres, probes, reached)


def approximate_top_k(
    queries: DataFrame, index: VectorIndex, k: int = 10, probes: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``queries(query_id, embedding)``: ``(query_id, id, similarity, rank)``, the best ``k`` of the ``probes``
    lists (by default as many as the index chose) whose centres are nearest; ties to the smaller id.

    Queries whose vector is null, not finite or of another width have no rows. A list and the queries that
    read it are cut into blocks of ``block_bytes`` by stored row numbers, and pairs of blocks are compared, so
    neither a huge list nor many queries of one list gather in a task. Lists that no query reads are not read."""
    spark, centres = queries.sparkSession, index.centres
    width, reads = centres.shape[1], min(probes or index.probes, len(centres))
    asked = _whole(queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")))
    asked = asked.filter(F.size("embedding") == width).withColumn("_n", F.monotonically_increasing_id())
    shared = spark.sparkContext.broadcast(centres)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                best = np.argsort(-(_matrix(part["embedding"]) @ shared.value.T), axis=1, kind="stable")[:, :reads]
                yield part.assign(cells=list(best.astype(np.int32)))

    ids = f"query_id {queries.schema['query_id'].dataType.simpleString()}"
    asked = written(asked.mapInPandas(near, f"{ids}, embedding array<double>, _n long, cells array<int>"), "asked")
    wanted = asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("_q"))
    held = index.lists.groupBy("cell").agg(F.count(F.lit(1)).alias("_v"))
    fit = max(1, block_bytes // (8 * width))
    # At most MOST_CELLS rows of three numbers, so a broadcast of them is bounded.
    sizes = F.broadcast(written(held.join(wanted, "cell").select(
        "cell", F.ceil(F.col("_v") / fit).alias("parts"), F.ceil(F.col("_q") / fit).alias("slots")), "sizes"))
    v = index.lists.join(sizes, "cell").select(
        "cell", F.pmod("_n", "parts").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"), "id", "embedding")
    q = asked.select("query_id", "embedding", "_n", F.explode("cells").alias("cell")).join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.pmod("_n", "slots").alias("slot"), "query_id", "embedding")

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "id": [], "similarity": []})
        return _best(
            left["query_id"].to_numpy(), _matrix(left["embedding"]), right["id"].to_numpy(), _matrix(right["embedding"]), k, None
        )

    ddl = f"{ids}, id {index.lists.schema['id'].dataType.simpleString()}, similarity double"
    keys = ("cell", "part", "slot")
    return _ranked(q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(block, ddl), k)
