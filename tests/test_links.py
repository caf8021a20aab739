"""Terms in texts by automata, and chunks linked with mentions in one join."""

import random

import pytest

import __spark_entry__
from pageloom.operators.chunks import SECTION, SUMMARY
from pageloom.operators.glossary import contains_join
from pageloom.operators.mentions import link_mentions

SF = "/root/testdata/sf0.001"
CHUNKS = "chunk_id string, source_article_id string, chunk_type string, char_start int, char_end int, entity_id int"
MENTIONS = "article_id string, entity_id string, position int, start_pos int, end_pos int, chunk_id int"


@pytest.mark.parametrize("shard_bytes", [1 << 20, 30])
def test_terms_in_texts(spark, shard_bytes):
    rng = random.Random(5)

    def word(n):
        return "".join(rng.choices("abé ", k=n))

    terms = [(i, word(rng.randint(0, 4)), "t") for i in range(60)] + [(60, None, "t"), (61, "ab", "t"), (62, "ab", "t")]
    texts = [(i, word(rng.randint(0, 30)), "x") for i in range(200)] + [(200, None, "x"), (201, "ab" * 200_000, "x"), (3, "ab", "x"), (3, "ab", "x")]
    a = spark.createDataFrame(terms, "seq int, term string, kind string")
    b = spark.createDataFrame(texts, "id int, body string, sort string").repartition(4)
    got = contains_join(a, b, "term", "body", shard_bytes, keep_text=False)
    assert got.columns == ["seq", "term", "kind", "id", "sort"]
    want = sorted((s, i) for s, t, _ in terms for i, x, _ in texts if t and x and t in x)
    assert sorted((r.seq, r.id) for r in got.collect()) == want
    assert contains_join(a.where("false"), b, "term", "body").count() == 0
    assert contains_join(a, b.where("false"), "term", "body").count() == 0


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    chunks, mentions = [], []
    for a in ("one", "two", "three"):
        chunks.append((f"{a}-summary", a, SUMMARY, None, None, 1))
        for n in range(40):
            start = rng.randint(0, 9000)
            chunks.append((f"{a}-{n}", a, SECTION, start, start + rng.choice([0, 1, 50, 5000]), 1))
    for n in range(900):
        start = rng.randint(0, 10_000)
        mentions.append((rng.choice(["one", "one", "two", "four", None]), f"e{n % 50}", start, start, start + rng.randint(1, 3000), 1))
    mentions += [("one", "placeless", 5, None, None, 1), ("two", "half", 6, 7, None, 1), mentions[0], mentions[0]]
    chunks += [("no-place", "one", SECTION, None, None, 1), ("no-article", None, SUMMARY, 0, 9, 1), ("one-summary", "one", SUMMARY, 3, 9, 1)]
    return chunks, mentions


@pytest.mark.parametrize("width, parts", [(2048, 16), (100, 3), (10**6, 1)])
def test_links_against_all_pairs(spark, tables, width, parts):
    chunks, mentions = tables
    want = []
    for c, a, kind, cs, ce, _ in chunks:
        for b, e, p, ms, me, _ in mentions:
            placed = None not in (cs, ce, ms, me)
            if a is not None and a == b and (kind == SUMMARY or (placed and ms < ce and me > cs)):
                want.append((c, a, e, p, me))
    got = link_mentions(spark.createDataFrame(chunks, CHUNKS), spark.createDataFrame(mentions, MENTIONS), width, parts)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_chunks_and_mentions_are_read_once(spark):
    plan = __spark_entry__.queries()["entity_chunk_index"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # documents for chunks, mentions and names; names join the words, chunks join the mentions
    assert plan.count("Relation [") == 3 and plan.count("Join ") == 2
