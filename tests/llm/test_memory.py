"""What a Python worker holds is bounded, whatever the texts are."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pageloom.llm import jaccard, words
from pageloom.llm.common import small_batches

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def near_copies(many, length, share):
    rng = random.Random(many)
    base = [f"w{rng.randint(0, 3000)}" for _ in range(length)]
    return [" ".join(f"x{rng.randint(0, 999)}" if rng.random() < share else w for w in base) for _ in range(many)]


def cluster(texts):
    own, none = pa.array(np.arange(len(texts))), pa.array(np.zeros(len(texts), np.int64))
    return pa.RecordBatch.from_arrays([none] * 4 + [own, own, pa.array(texts)], ["cluster", "one", "two", "block", "rep", "part", "text"])


@pytest.mark.parametrize(("many", "length", "share"), [(1500, 60, 0.005), (150, 6000, 0.03)])
def test_a_cluster_of_near_copies_is_compared_in_little_memory(many, length, share):
    batch = cluster(near_copies(many, length, share))
    tracemalloc.start()
    links = [x for found in jaccard.search_clusters(iter([batch])) for x in found.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(links) >= (many * 0.9 if length == 60 else 0)
    assert peak < 120e6, peak


def test_likeness_is_that_of_the_definition():
    rng = np.random.default_rng(3)
    maps = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in rng.choice([1, 2, 4], 40)]
    sizes = np.array([int(np.bitwise_count(m).sum()) + 1 for m in maps])
    i, j = (x.astype(np.int32) for x in np.triu_indices(40, 1))
    found = jaccard._likeness(maps, sizes, i, j)
    for a, b, x in zip(i, j, found):
        n = min(len(maps[a]), len(maps[b]))
        assert x == np.bitwise_count(maps[a][:n] & maps[b][:n]).sum() / (sizes[a] + sizes[b]) * (len(maps[a]) / n)


def test_many_short_members_make_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS", 16)
    seen = []
    real = jaccard.cluster_links
    monkeypatch.setattr(jaccard, "cluster_links", lambda clusters, texts: seen.append(clusters.count()) or real(clusters, texts))
    texts = near_copies(60, 40, 0.005)
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["id"]: r["component"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split()[a : a + 5]) for a in range(36)} for t in texts]
    want = list(range(60))
    changed = True
    while changed:
        changed = False
        for a in range(60):
            for b in range(60):
                if want[b] < want[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    want[a], changed = want[b], True
    assert got == dict(enumerate(want)) and seen


def test_word_hashes_do_not_depend_on_the_bytes_hashed_at_a_time(monkeypatch):
    texts = pa.array(["abc def " * 50, None, "x" * 5000, "end"])
    whole = words.word_hashes(texts)[0]
    monkeypatch.setattr(words, "BLOCK", 64)
    assert np.array_equal(words.word_hashes(texts)[0], whole)


def test_hashing_keeps_little():
    words._powers.cache_clear()
    column = pa.array(["word " * 400] * 1000)
    tracemalloc.start()
    words.word_hashes(column)
    peak = tracemalloc.get_traced_memory()[1]
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 8e6 and peak < 64e6, (kept, peak)


def test_texts_reach_the_workers_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    before = spark.conf.get(LIMIT, None)
    texts = spark.range(2000, numPartitions=1).selectExpr("repeat('some text ', 1000) as text")
    try:
        spark.conf.unset(LIMIT)
        small_batches(spark)
        assert texts.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0] < 8e6
        spark.conf.set(LIMIT, "16m")
        small_batches(spark)
        assert spark.conf.get(LIMIT) == "16m"
    finally:
        spark.conf.set(LIMIT, before) if before else spark.conf.unset(LIMIT)
