import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import numpy as np
import pyarrow as pa

from pageloom.llm import words
from pageloom.llm.queries import QUERIES
from pageloom.llm.substrings import COVER, PERIOD, brute_force, dedup_substrings

SCHEMA = "doc_id long, text string, id string, kept string"


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = dedup_substrings(df).select("id", "n_words", "n_removed", F.sha2("kept", 256))
    return sorted(map(tuple, got.collect()), key=repr)


def want(rows):
    return sorted(brute_force(rows), key=repr)


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_planted_repeats(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghijklmnop") * rng.randint(1, 3)
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 27, 60)]
    rows = []
    for i in range(120):
        w = [word() for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            w[at:at] = p[a:] if rng.random() < 0.5 else p
        rows.append((rng.randint(0, 10**12), rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [rows[5], (7, rows[6][1]), (8, rows[6][1]), (8, rows[7][1]), (8, rows[8][1] + " end")]
    rows += [(None, rows[9][1]), (None, None), (1, None), (2, ""), (3, "   "), (4, "again " * 5000), (-5, "é\x1c " * 40)]
    assert run(spark, rows) == want(rows)


def test_runs_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        text = " ".join(f"w{i}" for i in range(45))
        rows = [(i, text + f" end{i}") for i in range(40)] + [(50, "start " + text)]
        assert run(spark, rows) == want(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op2_substring_dedup"](spark, sf).collect()), key=repr)
    assert got == want(rows)
    assert sum(r[2] for r in got) > 0
    assert {len(r[3]) for r in got} == {64} and got[0][3] != hashlib.sha256(b"?").hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAé \n\t\x1cb", max_size=12)), max_size=6), st.sampled_from([1, 3, 1 << 21]))
def test_word_hashes(texts, block):
    words.BLOCK, before = block, words.BLOCK
    try:
        hashes, counts = words.word_hashes(pa.array(texts, pa.string()))
        folded, _ = words.word_hashes(pa.array(texts, pa.string()), fold=True)
    finally:
        words.BLOCK = before
    lists = [(t or "").encode().split() for t in texts]
    assert counts.tolist() == [len(x) for x in lists]
    flat = [w for x in lists for w in x]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    assert len(set(folded.tolist())) == len({w.lower() for w in flat})
    plain, _ = words.word_hashes(pa.array([" ".join(w.decode() for w in flat)]))
    assert np.array_equal(plain, hashes)


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_slices_keep_all_rows(most):
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["a" * 9, None, "", "b"])], ["i", "t"])
    assert [x for s in words.slices(batch, 1, most) for x in s.column(0).to_pylist()] == [1, 2, 3, 4]
