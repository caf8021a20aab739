"""Buffers, places of answers and passes against plain definitions, and the registered query as a whole."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as some

import __spark_entry__
from pageloom.functions.text import ENTITY_TYPES
from pageloom.operators.mentions import extract_mentions_with, valid_mentions
from pageloom.operators.passes import buffered, buffers, merge_passes, nearest, place
from pageloom.plans import standins

SF = "/root/testdata/sf0.001"
ARTICLES = "article_id string, chapter_number int, article_number int, markdown_content string, extra string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_nearest(text, wanted, share):
    low, budget = wanted.lower(), int(len(wanted) * share)
    found = [(edits(low, text[s:e].lower()), e, abs(e - s - len(wanted)), -s) for e in range(1, len(text) + 1) for s in range(e)]
    best = min(found, default=None)
    return (-best[3], best[1]) if best and best[0] <= budget and best[0] < len(wanted) else None


@settings(max_examples=150, deadline=None)
@given(some.text("abA ", max_size=14), some.text("abA", max_size=6), some.sampled_from([0.0, 0.25, 0.5, 1.0]))
def test_nearest_stretch(text, wanted, share):
    got, want = nearest(text, wanted, share), plain_nearest(text, wanted, share)
    assert got == want


@settings(max_examples=150, deadline=None)
@given(some.text("ab.! \n", max_size=80), some.integers(1, 12))
def test_buffers_cover_the_text(text, most):
    cuts = list(buffers(text, most))
    assert "".join(text[a:b] for a, b in cuts) == text
    assert all(0 < b - a <= most for a, b in cuts)


def test_cuts_lie_behind_sentences_then_blanks():
    assert list(buffers("One two. Three four five", 12)) == [(0, 9), (9, 20), (20, 24)]
    assert list(buffers("abcdefgh", 3)) == [(0, 3), (3, 6), (6, 8)]


def test_places_in_order_and_statuses():
    text = "Heron, heron and a Herons' nest. The great lakes"
    assert place(text, ["heron", "Heron", "heron", "graet lakes", "nothing alike", ""]) == [
        (7, 12, "match_exact"), (0, 5, "match_exact"), (None, None, "no_match"), (37, 48, "match_fuzzy"),
        (None, None, "no_match"), (None, None, "no_match")]


def test_first_pass_wins_where_spans_touch():
    text = "big red heron near a lake"
    first, later = [("x", "red heron", None), ("x", "gone", None)], [("y", "big red", None), ("y", "heron", None), ("y", "lake", None), ("x", "gone", None), ("y", "gone", None)]
    assert [(k, n, s) for k, n, s, *_ in merge_passes(text, [first, later])] == [
        ("x", "red heron", 4), ("x", "gone", None), ("y", "lake", 21), ("y", "gone", None)]
    same = merge_passes(text, [[("x", "red heron", None), ("y", "heron", None)]])
    assert len(same) == 2  # one pass may give spans that touch


def test_odd_articles(spark):
    long = "A sentence on herons. " * 100_000
    rows = [("a", 1, 1, None, "e"), ("b", 1, 2, "", "e"), ("c", 1, 3, "Herons here.", "e"), ("c", 1, 3, "Herons here.", "e"),
            (None, None, None, "Herons, heron", None), ("long", 2, 1, long, "e")]

    def model(texts, n):
        return [[("tool", m, {"n": [str(n)]}) for m in re.findall(r"\w*[Hh]erons?\w*", t)] for t in texts]

    articles = spark.createDataFrame(rows, ARTICLES)
    got = extract_mentions_with(articles, buffered(model))
    counts = {r.article_id: r["count"] for r in got.groupBy("article_id").count().collect()}
    assert counts == {"c": 2, None: 2, "long": 100_000}
    assert got.where("article_id = 'long'").selectExpr("max(position) m", "max(end_pos) e", "count(distinct start_pos) n").first()[:] == (99_999, len(long) - 2, 100_000)
    assert extract_mentions_with(articles.where("false"), buffered(model)).count() == 0


def plain_extraction(text):
    """The same by definition: every pair of spans is compared, places come from plain searches."""
    out = []
    for at, end in buffers(text, 1500):
        part, kept = text[at:end], []
        for n in (1, 2):
            given, used, earlier = standins.spelled([part], n)[0], {}, list(kept)
            for kind, name, _ in given:
                spans = [m.span() for m in re.finditer(rf"(?<!\w){re.escape(name)}(?!\w)", part)]
                status = "match_exact"
                if not spans:
                    span, status = nearest(part, name, 0.25), "match_fuzzy"
                    spans = [span] if span else []
                nth = used[name] = used.get(name, -1) + 1
                if nth >= len(spans):
                    if (kind, name) not in [(k, x) for k, x, s, *_ in earlier if s is None]:
                        kept.append((kind, name, None, None, "no_match"))
                    continue
                s, e = spans[nth]
                if not any(a is not None and a < e and b > s for _, _, a, b, _ in earlier):
                    kept.append((kind, name, s, e, status))
        out += [(k, x, s if s is None else s + at, e if e is None else e + at, status) for k, x, s, e, status in kept]
    return [(i, *row) for i, row in enumerate(out) if row[0] in ENTITY_TYPES]


@pytest.mark.parametrize("name", ["extract_buffered"])
def test_registered_query(spark, name):
    got = [r.asDict() for r in __spark_entry__.queries()[name](spark, SF).collect()]
    want = []
    for r in standins.articles(spark, SF).select("article_id", "markdown_content").collect():
        want += [(r.article_id, *row) for row in plain_extraction(r.markdown_content or "")]
    columns = ["article_id", "position", "entity_type", "name", "start_pos", "end_pos", "alignment_status"]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted((tuple(r[c] for c in columns) for r in got), key=key) == sorted(want, key=key)
    assert {r["alignment_status"] for r in got} == {"match_exact", "match_fuzzy", "no_match"}
    assert {(r["alignment_status"], r["confidence"]) for r in got} == {("match_exact", 1.0), ("match_fuzzy", 0.8), ("no_match", 0.5)}
