"""Words that begin no name stay in their text, names meet relationships where these are, ids are counted unmerged."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.operators import passes
from pageloom.operators.mentions import extract_mentions, first_words, words_with_offsets
from pageloom.operators.relations import collect_relationships, resolve_relationships
from pageloom.operators.rollups import enrichment_counts
from pageloom.plans import standins as st

ARTICLES = "article_id string, chapter_number int, article_number int, markdown_content string"
NAMES = [("heron", "tool"), ("écluse", "role"), ("grey heron", "tool"), (None, "tool"), ("i̇zmir", "role")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_words_that_may_begin_a_name_leave_the_text(spark):
    text = "Heron " + " ".join(f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)) + " ÉCLUSE İzmir grey HERON"
    arts = spark.createDataFrame([("a", 1, 1, text), ("b", 1, 2, None), ("c", 1, 3, "…")], ARTICLES)
    names = spark.createDataFrame(NAMES, "name string, entity_type string")
    listed = names.withColumn("word", F.split_part("name", F.lit(" "), F.lit(1)))
    some = words_with_offsets(arts, "markdown_content", 1, first_words(listed))
    every = words_with_offsets(arts, "markdown_content", 1)
    assert some.exceptAll(every).count() == 0 and every.count() == 405
    assert some.count() < 60 and every.join(listed, "word").select(*every.columns).exceptAll(some).count() == 0
    found = [(r.start_pos, r.source_text) for r in extract_mentions(arts, names).orderBy("start_pos", "end_pos").collect()]
    assert [t for _, t in found] == ["Heron", "ÉCLUSE", "İzmir", "grey HERON", "HERON"]
    assert all(text[a : a + len(t)] == t for a, t in found)
    assert "Exchange hashpartitioning" not in plan(extract_mentions(arts, names, max_words=1))


def test_empty_gazetteer(spark):
    arts = spark.createDataFrame([("a", 1, 1, "Heron")], ARTICLES)
    assert extract_mentions(arts, spark.createDataFrame([], "name string, entity_type string")).count() == 0


@pytest.fixture
def apart(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, -1)
    yield
    spark.conf.unset(key)


def test_names_meet_relationships_where_these_are(spark, apart):
    arts = spark.createDataFrame([(f"a{i}", 1, i, "heron stork heron crane stork " * 5) for i in range(8)], ARTICLES)
    names = spark.createDataFrame([("heron", "tool"), ("stork", "role"), ("crane", "tool")], "name string, entity_type string")
    found = extract_mentions(arts, names, max_words=1).localCheckpoint()
    rels = resolve_relationships(st.raw_relationships(found), found)
    shown = plan(rels)
    assert shown.count("SortMergeJoin") == 2 and "Exchange hashpartitioning(article_id" in shown
    assert "_source" not in "".join(x for x in shown.splitlines() if "Exchange hashpartitioning" in x)
    assert "_target" not in "".join(x for x in shown.splitlines() if "Exchange hashpartitioning" in x)
    merged = found.dropDuplicates(["entity_id"])
    a, b = enrichment_counts(found, merged, collect_relationships(rels)).first(), enrichment_counts(found, found, rels).first()
    assert a == b and a.entity_count == 3 and 0 < a.relationship_count < rels.count()


def test_ends_of_many_patterns_at_once():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abé漢 "), 300))
    wanted = ["".join(rng.choice(list("abé漢 "), n)) for n in (0, 1, 4, 4, 4, 9, 9, 17)]
    codes, patterns = passes._codes(text), [passes._codes(w) for w in wanted]
    for most in (1, 700, 1 << 21):
        ends = passes._ends(patterns, codes, most)
        for i, pattern in enumerate(patterns):
            row = passes._distances(pattern, codes, False)
            assert ends[i] == (int(row.argmin()), int(row.min()))
    assert passes._ends([passes._codes("ab")], passes._codes(""))[0] == (0, 2)


def test_occurrences_are_those_of_a_pattern():
    text = "an anan an\u0301 an_ (an) an an-an é an\U0001f600an 9an aa aaa a a a an"
    for answer in ("an", "a", "aa", "a a", "an an", "an-an", "é", " ", "(an)", "", "\U0001f600", "an\u0301", "zz"):
        found = passes.regex.finditer(rf"(?<!\w){passes.regex.escape(answer, literal_spaces=True)}(?!\w)", text) if answer else ()
        assert passes._occurrences(text, answer) == [m.span() for m in found]
