import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pageloom.llm import leaks
from pageloom.llm.leaks import RATE, Matcher, distances, find_leaks, normalised, pieces, symbol_masks, without_leaks
from pageloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, leaks string, row string, item_id string"
ITEMS = "item_id long, text string, doc_id string"


def least(item, text):
    """Fewest edits between the item and any stretch of the text, by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i - 1] + (c != d), row[i] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abcd", max_size=30))
def test_bit_parallel_distance(item, text):
    assert min([len(item), *distances(symbol_masks(item), len(item), text)]) == least(item, text)


def brute_force(rows, items):
    out = []
    for i, t in rows:
        for j, s in items:
            if j is not None and t and s and normalised(s):
                d = least(normalised(s), normalised(t))
                if d <= int(RATE * len(normalised(s))):
                    out.append((i, j, d))
    return sorted(out, key=repr)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text) + 1)
        text[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", " "])
    return "".join(text)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("etaoin shr", k=rng.randint(2, 7))).strip() or "a"
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 30)))) for k in range(8)]
    items += [(20, None), (21, ""), (None, "no id at all"), (22, "  "), (3, "second text of item three, longer"), items[2]]
    rows = []
    for k in range(60):
        words = [word() for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.7:
            s = rng.choice(items[:8])[1]
            words.insert(rng.randint(0, len(words)), edited(rng, s.upper() if k % 3 else s.replace(" ", "\n "), rng.randint(0, 14)))
        rows.append((k, " ".join(words)))
    rows += [(100, None), (101, ""), (None, items[1][1]), rows[0], (102, "blah " * 3000 + items[4][1])]
    return rows, items


def test_against_brute_force(spark, case):
    rows, items = case
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], DOCS)
    table = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    got = find_leaks(docs, table).collect()
    want = brute_force(rows, list(dict.fromkeys(items)))
    assert sorted(((r.id, r.item_id, r.distance) for r in got), key=repr) == want
    assert any(r.distance > 0 for r in got) and len(want) > 15
    kept = without_leaks(docs, table)
    assert kept.columns == docs.columns
    dirty = {i for i, _, _ in want}
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted(((i, t) for i, t in rows if i not in dirty), key=repr)


def test_blocks_of_items(spark, case, monkeypatch):
    rows, items = case
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], DOCS)
    table = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    whole = sorted(map(repr, find_leaks(docs, table).collect()))
    monkeypatch.setattr(leaks, "BLOCK", 200)
    assert sorted(map(repr, find_leaks(docs, table).collect())) == whole


def test_spans():
    item = "the quick brown fox jumps over the lazy dog"
    text = "before it THE quick  brown fax jumps over the lazy dog and after"
    (hit,) = Matcher(((1, item),), RATE).match(text)
    assert hit["distance"] == 1 and normalised(text)[hit["begin"] : hit["end"]] == "the quick brown fax jumps over the lazy dog"


def test_pieces_cover_the_item():
    assert "".join(p for _, p in pieces("abcdefghij", 3)) == "abcdefghij" and len(pieces("abcdefghij", 3)) == 4


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    table = spark.createDataFrame([(1, "some item text", "x")], ITEMS)
    assert find_leaks(docs, table).collect() == []
    one = spark.createDataFrame([(1, "some item text", "a", "b", "c")], DOCS)
    assert find_leaks(one, table.where("item_id < 0")).collect() == []
    assert without_leaks(one, table.where("item_id < 0")).count() == 1


def test_whole_small_table(spark):
    """Of a large table only pairs that share a run of words are worth the plain table; all others are far apart."""
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {(r.doc_id, b.item_id) for r in rows for b in items if normalised(b.text) in normalised(r.text)}
    got = QUERIES["op5_decontamination"](spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.distance == 0} == want and want
