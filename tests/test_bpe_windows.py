"""Byte-pair windows come from the worker that makes the tokens; they equal windows over single tokens."""

from pyspark.sql import functions as F

from pageloom.functions import tokens as tok
from pageloom.operators.chunks import ChunkParams, chunk_articles

TEXTS = ["", "a", "one two three four five six seven", "漢字 é😀 ﷽ w1 w2 " * 30, "x " * 500, None, " lead 😀😀😀", "naïve — ‘quoted’ क्ष " * 9]


def test_windows_equal_those_over_single_tokens(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").where("text is not null")
    for size, overlap in ((4, 1), (64, 8), (3, 2)):
        new = df.select("id", F.inline_outer(tok.bpe_windows(F.col("text"), size, overlap)))
        old = df.select("id", tok.bpe_tokens(F.col("text")).alias("t")).select("id", F.inline_outer(tok.windows_of(F.col("t"), size, overlap)))
        assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


def test_counts_and_lead(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    m = tok.bpe_counts_and_lead(F.array("text", F.lit("b c")), F.col("text"), 3)
    rows = df.select("text", m.alias("m"), tok.truncate(F.col("text"), 3, "bpe").alias("lead"), tok.bpe_count(F.col("text")).alias("n")).collect()
    for r in rows:
        assert r.m.lead == r.lead and r.m.counts == [r.n, 2]


def test_runs_hold_every_row(spark, monkeypatch):
    import pyarrow as pa

    texts = ["x" * n for n in (5, 0, 30, 1, 1, 1, 40)] + [None]
    runs = list(tok._runs(10, pa.array(texts), pa.array(range(8))))
    assert [t for run in runs for t in run[0]] == texts and [i for run in runs for i in run[1]] == list(range(8)) and len(runs) > 2


def test_two_python_steps_and_no_token_arrays(spark):
    rows = [("a1", 1, "T", "s one two. " * 80, [("h", 2, "one two three " * 40), (None, 2, "short")])]
    arts = spark.createDataFrame(rows, "article_id string, chapter_number int, title string, markdown_content string, "
                                       "sections array<struct<heading: string, level: int, content: string>>")
    params = ChunkParams(summary_max_tokens=30, section_min_tokens=5, window_threshold=60, window_size=32, window_overlap=4, tokenizer="bpe")
    df = chunk_articles(arts, None, params)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2
    got = df.select("chunk_type", "token_count", "text").collect()
    assert sum(r.chunk_type == "sliding_window" for r in got) > 2 and all(r.token_count > 0 for r in got)
