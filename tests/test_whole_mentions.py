from collections import Counter

import regex

from pageloom.operators.mentions import extract_mentions
from __spark_entry__ import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_word_is_a_mention(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    words = Counter(w.lower() for r in docs for w in regex.findall(r"\p{L}+", r.text or ""))
    got = QUERIES["extract_mentions_whole"](spark, SF)
    found = {r["name"]: r["count"] for r in got.groupBy("name").count().collect()}
    assert {n: k for n, k in found.items() if " " not in n} == dict(words)
    assert any(" " in n for n in found)


def test_names_with_a_frequent_first_word(spark):
    """Rows of the join grow with the text, not with words times names of the same first word."""
    text = " ".join(f"the thing{'abcdefghij'[k % 10]}" for k in range(300))
    arts = spark.createDataFrame([("a", 1, 1, text)], "article_id string, chapter_number int, article_number int, markdown_content string")
    names = spark.createDataFrame([(f"the thing{c}", "tool") for c in "abcdefghij"] + [("the", "tool"), ("the  thinga", "tool")], "name string, entity_type string")
    df = extract_mentions(arts, names)
    got = Counter(r.name for r in df.collect())
    assert got == {"the": 300, **{f"the thing{c}": 30 for c in "abcdefghij"}}
    plan = df._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("name#" in line for line in joins[:1])
