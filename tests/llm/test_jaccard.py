import random

import numpy as np
import pytest

from pageloom.llm import jaccard
from pageloom.llm.components import connected
from pageloom.llm.jaccard import jaccard_components, tree_pairs
from pageloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id string, n long, name string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(LOWER).encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_force(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted([(i, len(s), None if i is None else root(i)) for i, s in sets], key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 0, "y") for i, t in rows], SCHEMA)
    return sorted(map(tuple, jaccard_components(df).collect()), key=repr)


def near(rng, words, share):
    return [rng.choice("xyz") + str(rng.randint(0, 999)) if rng.random() < share else w for w in words]


def sample(seed, families, size):
    rng = random.Random(seed)
    common = ["shared", "line", "that", "many", "texts", "hold", "at", "their", "end"]
    rows = []
    for f in range(families):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 5, 8, 30, 60, 200]))]
        for _ in range(rng.randint(1, size)):
            w = near(rng, base, rng.choice([0, 0.01, 0.02, 0.05]))
            w = w[rng.randint(0, 2) :] + (common if rng.random() < 0.4 else [])
            rows.append((rng.randint(-(10**9), 10**12), " ".join(w)))
    return rows


def test_against_brute_force(spark):
    rows = sample(5, 60, 8)
    rows += [(1, "A b C d E f"), (2, "a B c d e F"), (3, "one two"), (4, "ONE two"), (5, "one"), (6, "one two one"), (7, ""), (8, None), (9, "  ")]
    rows += [(10, ""), (None, "a b c d e f"), (None, None), rows[0], rows[1], (rows[2][0], rows[3][1]), (11, "long " * 9000), (12, "long " * 8000)]
    assert run(spark, rows) == brute_force(rows)


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2000)
    monkeypatch.setattr(jaccard, "MEMBERS", 16)
    monkeypatch.setattr(jaccard, "NAMED", 4)
    rng = random.Random(1)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(near(rng, base, 0.03))) for k in range(150)] + [(k, " ".join(base[:20] + [f"u{k}_{n}" for n in range(12)])) for k in range(200, 300)]
    assert run(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op8_ngram_jaccard_join"](spark, sf).collect()), key=repr)
    assert got == brute_force(rows)


def test_traversal_keeps_every_link():
    rng = np.random.default_rng(2)
    sets, names = [], []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(1, 150)).astype(np.uint64)
        for _ in range(6):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.05], rng.integers(0, 2**63, 2).astype(np.uint64)])))
            names.append(len(names))
    sizes = np.array([len(x) for x in sets])
    rows, grams = np.repeat(np.array(names), sizes), np.concatenate(sets)
    maps = jaccard.bitmaps(rows, grams, sizes, jaccard.bitmap_bits(sizes))
    parts = rng.integers(0, 30, len(sets))
    x, y = tree_pairs(sizes, maps, parts)
    found = {(min(p), max(p)) for p in zip(x.tolist(), y.tolist())}
    links = set()
    for i in names:
        for j in names[:i]:
            both = len(np.intersect1d(sets[i], sets[j]))
            if parts[i] != parts[j] and 4 * both >= 3 * (sizes[i] + sizes[j] - both):
                links.add((j, i))
    assert links and links <= found
    assert len(found) < len(names) ** 2 / 8


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(9, k) for k in range(20, 40)] + [(3, 40), (40, 39)], [(1, 1), (2, 3), (3, 2)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "x long, y long")
    parent = {}
    for a, b in edges:
        if a != b:
            group = {n for n, r in parent.items() if r in (parent.get(a, a), parent.get(b, b))} | {a, b}
            parent |= dict.fromkeys(group, min(parent.get(n, n) for n in group))
    assert dict(map(tuple, connected(df).collect())) == parent
