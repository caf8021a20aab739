import math

import numpy as np
import pytest

from pageloom.llm import queries, whitening
from pageloom.llm.whitening import above, feast, intervals, top_components, whiten

SCHEMA = "vec_id long, embedding array<double>, id string, component string, x string"
RNG = np.random.default_rng(5)
TURN, _ = np.linalg.qr(RNG.normal(size=(40, 40)))
MATRICES = {
    "isotropic": np.cov(np.floor(8 * RNG.normal(size=(400, 40))).T),
    "few rows": np.cov(np.floor(8 * RNG.normal(size=(12, 40))).T),
    "steep": TURN @ np.diag(np.geomspace(1e10, 1e-2, 40)) @ TURN.T,
    "ties": TURN @ np.diag([3.0, 3, 3, 2, 2] * 3 + [1.0] * 25) @ TURN.T,
    "close": TURN @ np.diag(1 + 1e-8 * np.arange(40)) @ TURN.T,
    "same": 7 * np.eye(40),
    "one": np.array([[2.0]]),
    "ones": np.ones((9, 9)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_components(name):
    a = (MATRICES[name] + MATRICES[name].T) / 2
    want = np.linalg.eigvalsh(a)[::-1]
    e, v = top_components(a, 16)
    real = int((want[:16] > 1e-10 * want[0]).sum())
    assert len(e) == real and (np.diff(e) <= 1e-12 * e[0]).all()
    np.testing.assert_allclose(e, want[:real], atol=1e-13 * want[0])
    np.testing.assert_allclose(v.T @ v, np.eye(real), atol=1e-11)
    assert np.abs(a @ v - v * e).max() < 1e-12 * want[0]


@pytest.mark.parametrize("name", ["isotropic", "steep", "ties", "close"])
def test_inertia_and_intervals(name):
    a = (MATRICES[name] + MATRICES[name].T) / 2
    values = np.linalg.eigvalsh(a)
    for shift in np.concatenate([RNG.uniform(values[0], values[-1], 20), [0.0, -1.0, values[-1] * 1.1]]):
        assert above(a, shift) == (values > shift).sum()
    found = intervals(a / np.abs(a).max(), 16)
    assert sum(n for *_, n in found) >= 16 and all(p[0] == q[1] for p, q in zip(found, found[1:]))
    low, high, n = found[0]
    assert len(feast(a / np.abs(a).max(), low, high, n, RNG)[0]) == n


def test_blocks_of_two_count_once():
    a = np.array([[0.0, 5.0, 0.0], [5.0, 0.0, 0.0], [0.0, 0.0, -1.0]])
    assert above(a, 0.0) == 1 and above(np.zeros((3, 3)), 0.0) == 0


def brute_force(rows, most=16):
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(n * c - s) for c, s in zip(x, sums)] for x in fit]) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    trace = (y**2).sum() / n
    out = {}
    for i, x in kept:
        off = [n * c - s for c, s in zip(x, sums)]
        w = np.array([o / n for o in off]) @ v / np.sqrt(np.maximum(e, 1e-300))
        out.setdefault(i, []).append((n, sum(o * o for o in off), w, e / trace))
    return out


def check(spark, rows, most=16):
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA).repartition(3)
    got = {}
    for r in whiten(df, most).collect():
        got.setdefault(r.id, []).append(r)
    want = brute_force(rows, most)
    assert set(got) == set(want)
    signs = {}
    for i, found in got.items():
        n, deviation, w, explained = want[i][0]
        assert len(found) == len(want[i]) * len({r.component for r in found})
        for r in found:
            assert (r.n, int(r.deviation)) == (n, deviation) and r.identity_error <= 1e-4
            assert abs(r.explained - explained[r.component - 1]) <= 1e-4 * r.explained
            if abs(w[r.component - 1]) > 1e-6:
                signs.setdefault(r.component, set()).add(np.sign(r.whitened * w[r.component - 1]))
            assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-7 * max(1, abs(w[r.component - 1]))
    assert all(len(s) == 1 for s in signs.values())
    return got


def vectors(n, d, scale=0.2, shift=0.0):
    rng = np.random.default_rng(n + d)
    return [(i, [float(x) for x in rng.normal(size=d) * scale * np.linspace(2, 1, d) + shift]) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(700, 20)
    rows += [rows[3], (None, rows[4][1]), (9001, rows[5][1]), (9002, None), (9003, [None] * 20), (9004, [float("nan")] * 20), (9005, [float("inf")] + [0.0] * 19), (9006, [])]
    got = check(spark, rows)
    assert max(len(v) for v in got.values()) == 32 and len(got[1]) == 16


def test_far_mean_and_large_entries(spark):
    check(spark, vectors(300, 6, 0.5, shift=-3e6), 4)
    check(spark, vectors(200, 5, 1e7), 5)


def test_fewer_dimensions_than_components(spark):
    got = check(spark, vectors(100, 3))
    assert all(len(v) == 3 for v in got.values())


def test_dependent_dimensions_have_no_rows(spark):
    rows = [(i, [v[0], v[0], 1.0, v[1]]) for i, v in vectors(80, 2)]
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)
    assert {r.component for r in whiten(df).collect()} == {1, 2}


def test_hot_vector_counts_once(spark):
    rows = vectors(60, 4) + [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(400)]
    check(spark, rows, 3)


def test_nothing(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [float("nan")])]):
        df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)
        assert whiten(df).collect() == []


def test_most_frequent_width(spark):
    rows = vectors(50, 3) + [(900, [1.0, 2.0]), (901, [1.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)
    assert {r.id for r in whiten(df).collect()} == set(range(50))


def test_numbers_beyond_exact_doubles():
    x = np.array([[1 << 40, 3], [-(1 << 40), 5]])
    sums, many = whitening._products(x, np.zeros(2, np.int64))
    assert sums.tolist() == [0, 8] and many.tolist() == [[1 << 81, -2 << 40], [-2 << 40, 34]]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_force(rows)
    got = queries.QUERIES["op12_embedding_whitening"](spark, sf).collect()
    assert len(got) == 16 * len(rows)
    for r in got:
        n, deviation, w, explained = want[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation) and abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-9
        assert r.identity_error < 1e-9 and abs(r.explained - explained[r.component - 1]) < 1e-9
