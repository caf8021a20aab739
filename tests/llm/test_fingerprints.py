import hashlib
import inspect
import random

import pytest
from pyspark.sql import functions as F

from pageloom.llm import fingerprints as f
from pageloom.llm import queries
from pageloom.llm.fingerprints import fingerprints, likeness

SCHEMA = "doc_id long, text string, id string, row int, key string, size int"


def pieces(text):
    out = []
    for line in (text or "").split("\n"):
        while line:
            at = min(120, len(line))
            while at < len(line) and line[at] not in ".!?":
                at += 1
            while at < len(line) and line[at] in ".!?":
                at += 1
            out.append(line[:at].strip(" "))
            line = line[at:]
    return {p for p in out if p}


def near(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def brute_force(rows):
    by = {}
    for i, text in rows:
        by.setdefault(i, set()).add(text or "")
    order = sorted(by, key=lambda i: (i is not None, i or 0))
    after = dict(zip(order, order[1:] + order[:1]))
    out = []
    for i, text in rows:
        text = text or ""
        (following,) = by[after[i]]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near(text, edited), 12), round(near(text, following), 12)))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "a", 1, "b", 2) for r in rows], SCHEMA).repartition(3)
    got = fingerprints(df).collect()
    return got, sorted(((r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in got), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["alpha", "bé", "𝒳𝒴", "delta.", "gamma!", "e?", "\n", "\n\n", "zeta", "  ", "..."]
    rows = [(i * 3 - 50, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 20, 60, 400])))) for i in range(120)]
    rows += [(1000, rows[9][1]), (1001, rows[9][1]), (1002, None), (1003, ""), (1004, "abc"), (1005, "abcd"), (1006, "x"), (1007, "y" * 1000), (1008, "   \n \n")]
    return rows + [(None, "The one without an id. " * 9), rows[4], rows[4]]


def test_against_brute_force(spark, rows):
    got, found = run(spark, rows)
    assert found == brute_force(rows)
    same = {r.n_chars: r for r in got if r.id in (1000, 1001)}
    assert len({r.fingerprint for r in got if r.id in (1000, 1001)}) == 1 and len(same) == 1
    assert all(r.fingerprint == "" for r in got if r.id in (1002, 1003, 1008))
    assert all((r.near_edited == 1.0) >= (r.fingerprint == r.edited_fingerprint) for r in got)


@pytest.mark.parametrize("cells, turns, tries", [(3, 9, 6), (24, 1, 2), (24, 9, 1)])
def test_failures_are_tried_larger_or_compared(spark, rows, monkeypatch, cells, turns, tries):
    monkeypatch.setattr(f, "CELLS", cells)
    monkeypatch.setattr(f.peel, "__kwdefaults__", {"turns": turns})
    monkeypatch.setattr(f, "TRIES", tries)
    few = [r for r in rows if r[0] is not None][:40]
    assert run(spark, few)[1] == brute_force(few)


def test_long_text(spark):
    text = "\n".join(f"line {i} of a long text" for i in range(20_000))
    rows = [(1, text), (2, text[:-30] + "end"), (3, "word " * 100_000)]
    assert run(spark, rows)[1] == brute_force(rows)


def test_small_tables(spark):
    assert run(spark, []) == ([], [])
    for rows in ([(5, "only one. " * 30)], [(None, None)], [(1, "a b c d"), (2, "")]):
        assert run(spark, rows)[1] == brute_force(rows)


def test_peeling_recovers_the_digests(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 5, 8], [2, 3, 4])], "row int, mine array<long>, other array<long>")
    sides = df.select("row", F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("digests")) for i, c in enumerate(("mine", "other"))])).alias("s"))
    sides = sides.select("row", "s.*", F.lit(60).cast("long").alias("size"), F.lit(0).alias("seed"))
    left = f.peel(f.subtract(f.cells_of(sides, "row", "side"), "row"), "row").collect()
    assert sorted((r.found, r.n) for r in left) == [(1, 1), (4, -1), (5, 1), (8, 1)]


def test_likeness_of_empty_sides(spark):
    df = spark.createDataFrame([(1, [], []), (2, [7], []), (3, [7], [7])], "row int, mine array<long>, other array<long>")
    assert {r.row: r.near for r in likeness(df, "row").collect()} == {1: 1.0, 2: 0.0, 3: 1.0}


def test_no_python_and_few_shuffles(spark, rows):
    source = inspect.getsource(f)
    assert not any(x in source for x in ("pandas", "InArrow", "udf", ".rdd", "createDataFrame"))
    df = spark.createDataFrame([(*r, "a", 1, "b", 2) for r in rows], SCHEMA)
    pairs = df.select("doc_id", F.array(F.col("doc_id")).alias("mine"), F.array(F.col("doc_id")).alias("other"))
    plan = f.differences(pairs, F.lit(24), 0, "doc_id")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange ") == 1 and "Python" not in plan


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_document_fingerprints"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in got), key=repr) == brute_force(rows)
