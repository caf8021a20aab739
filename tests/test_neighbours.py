"""The approximate lookup against the exact one: recall, whole lists, blocks, odd rows."""

import tracemalloc

import numpy as np
import pytest

from pageloom.operators.neighbours import VectorIndex, approximate_top_k, build_vector_index, nearest
from pageloom.operators.vectors import _best, cosine_top_k
from pageloom.session import shared_path

VECTORS, QUERIES = "id string, embedding array<double>, cell string", "query_id int, embedding array<double>, slot int"


@pytest.fixture(scope="module")
def tables(spark):
    """Forty clusters; one holds a third of all rows."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(40, 16)) * 3
    own = np.where(rng.random(1500) < 1 / 3, 0, rng.integers(0, 40, 1500))
    points = middles[own] + rng.normal(size=(1500, 16))
    rows = [(f"v{i}", p.tolist(), "x") for i, p in enumerate(points)]
    rows += [("v7", rows[7][1], "x"), ("none", None, "x"), ("nan", [float("nan")] * 16, "x"), ("gap", [None] + [1.0] * 15, "x"),
             ("narrow", [1.0] * 3, "x"), ("empty", [], "x"), ("zero", [0.0] * 16, "x")]
    asked = [(i, rows[i][1], 1) for i in range(0, 1500, 15)] + [(-1, None, 1), (-2, [1.0], 1), (-3, [float("inf")] * 16, 1)]
    return spark.createDataFrame(rows, VECTORS).repartition(4), spark.createDataFrame(asked, QUERIES).repartition(3)


def pairs(df):
    return {(r.query_id, r.id, r["rank"]): round(r.similarity, 9) for r in df.collect()}


def exact(tables):
    vectors, queries = tables
    return cosine_top_k(queries.filter("query_id >= 0"), vectors.filter("id not in ('none', 'nan', 'gap', 'narrow', 'empty')"), 10)


def test_recall_and_every_row_is_in_a_list(tables):
    vectors, queries = tables
    index = build_vector_index(vectors)
    assert index.lists.count() == 1502 and index.probes < len(index.centres)
    got, want = pairs(approximate_top_k(queries, index)), pairs(exact(tables))
    hits = {(q, i) for q, i, _ in got} & {(q, i) for q, i, _ in want}
    assert {q for q, _, _ in got} == {q for q, _, _ in want}
    assert len(hits) >= 0.9 * len({(q, i) for q, i, _ in want})


@pytest.mark.parametrize("block_bytes", [8 << 20, 8 * 16 * 20])
def test_all_lists_give_the_exact_answer(tables, block_bytes):
    vectors, queries = tables
    index = build_vector_index(vectors, cells=9)
    assert pairs(approximate_top_k(queries, index, 10, probes=9, block_bytes=block_bytes)) == pairs(exact(tables))


def test_saved_index_and_small_sample(spark, tables):
    vectors, queries = tables
    index = build_vector_index(vectors, sample_bytes=8 * 16 * 64)
    path = shared_path(spark, "saved")
    index.save(path)
    again = VectorIndex.load(spark, path)
    assert again.probes == index.probes and again.lists.count() == 1502
    assert pairs(approximate_top_k(queries, again)) == pairs(approximate_top_k(queries, index))


def test_no_vectors_and_no_queries(tables):
    vectors, queries = tables
    index = build_vector_index(vectors.filter("id = 'none'"))
    assert approximate_top_k(queries, index).count() == 0
    assert approximate_top_k(queries.filter("query_id < 0"), build_vector_index(vectors, cells=4)).count() == 0


def test_passes_agree(tables):
    vectors, queries = tables
    kept = vectors.filter("id not in ('none', 'nan', 'gap', 'narrow', 'empty')")
    few = queries.filter("query_id >= 0")
    assert pairs(cosine_top_k(few, kept, 5, max_broadcast=7)) == pairs(cosine_top_k(few, kept, 5))


def test_memory_does_not_grow_with_queries_times_vectors():
    rng = np.random.default_rng(5)
    queries, vectors = rng.normal(size=(3000, 4)), rng.normal(size=(4000, 4))
    tracemalloc.start()
    found = _best(np.arange(3000), queries, np.arange(4000), vectors, 3, None)
    own, sims = nearest(queries, vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = queries @ vectors.T
    assert peak < 8 * 3000 * 4000 / 3 and (own == whole.argmax(axis=1)).all() and np.allclose(sims, whole.max(axis=1))
    assert (found["id"].to_numpy().reshape(3000, 3) == np.argsort(-whole, axis=1, kind="stable")[:, :3]).all()
