import math

import numpy as np
import pytest

from pageloom.llm import topk
from pageloom.llm.topk import Forward, inner, top_k

SCHEMA = "vec_id long, embedding array<float>, score string, query_id string, rank string"


def brute_force(rows, asked, k):
    best = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            w = tuple(math.floor(1024 * float(np.float32(x))) for x in v)
            best[i] = min(best.get(i, w), w)
    out = []
    for q in {i for i in asked if i in best}:
        found = sorted((-sum(a * b for a, b in zip(best[q], v)), i) for i, v in best.items() if i != q and len(v) == len(best[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, asked, k):
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)
    return sorted(map(tuple, top_k(df, df.where(df.vec_id.isin(list(asked))), k).collect()))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "STRETCH", 16)
    monkeypatch.setattr(topk, "BATCH", 5)
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=6).astype("float32").tolist()) for i in range(0, 900, 5)]
    rows += [(i, [0.5] * 6) for i in range(1001, 1040)]
    rows += [(2000, None), (2005, []), (2010, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2015, [float("nan")] * 6), (2020, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (2025, [1.0, 2.0]), (2030, [2.0, 1.0]), (2035, [-3.0, 1.0]), (0, [9.0] * 6), rows[3], (-7, [0.0] * 6)]
    asked = [i for i, _ in rows if i is not None and i % 15 == 0] + [1001, 2025]
    assert run(spark, rows, asked, 10) == brute_force(rows, asked, 10)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    assert run(spark, rows, [0], 10) == [(0, 1, 1, 1024 * 2048), (0, 2, 2, 1024 * 2048)]
    assert run(spark, rows[:1], [0], 10) == []
    assert run(spark, [], [0], 10) == []


def test_large_components_stay_exact():
    rows, queries = np.array([[2.0**40 + 1, 3.0]]), np.array([[2.0**20 + 1, 5.0]])
    assert inner(rows, queries).tolist() == [[(2**40 + 1) * (2**20 + 1) + 15]]


def test_blocks_are_left_out(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 10)
    calls = []
    monkeypatch.setattr(topk, "inner", lambda r, q: calls.append(1) or inner(r, q))
    values = 100 * np.repeat(np.arange(10.0), 10)[:, None]
    list(Forward(np.arange(100), values).search(np.array([-1]), np.array([[1.0]]), 3))
    assert len(calls) == 1


@pytest.mark.parametrize("n", [3, 50])
def test_ties_go_to_smaller_ids(n):
    ids = np.arange(n)[::-1].copy()
    assert ids[topk._best(np.ones(n, np.int64), ids, 2)].tolist() == [0, 1]
