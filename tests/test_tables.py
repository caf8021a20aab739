"""Properties of chunks, mentions, keys and vectors; plans that must keep their shape."""

import pytest
from pyspark.sql import functions as F

from pageloom.functions.text import chunk_id
from pageloom.functions.tokens import token_windows
from pageloom.operators import glossary as gl
from pageloom.operators import keyed, mentions, relations, vectors
from pageloom.operators.chunks import ChunkParams, chunk_articles
from pageloom.plans import standins as st

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("tokenizer", ["word", "bpe"])
def test_windows_cover_and_overlap(spark, tokenizer):
    text = " ".join(f"w{i}漢字é" for i in range(300))
    rows = token_windows(spark.createDataFrame([(1, text)], "id int, text string"), "text", 64, 8, tokenizer).orderBy("window").collect()
    assert rows[0].start == 0 and rows[-1].end == len(text)
    for r in rows:
        assert text[r.start:r.end] == r.text
    for a, b in zip(rows, rows[1:], strict=False):
        assert b.start < a.end and a.token_count == 64


def test_window_parameters():
    with pytest.raises(ValueError):
        ChunkParams(window_size=8, window_overlap=8)


def test_unknown_chunk_type_is_an_error(spark):
    df = spark.range(1).select(chunk_id(F.lit("a"), F.lit("odd"), F.lit(1), F.lit(None).cast("int")))
    with pytest.raises(Exception, match="no chunk id rule"):
        df.collect()


def test_chunk_ids_are_unique_and_partitioning_does_not_matter(spark):
    arts = st.articles(spark, SF)
    a = chunk_articles(arts, None, st.PARAMS)
    assert keyed.duplicate_keys(a, ["chunk_id"]).count() == 0
    b = chunk_articles(arts.repartition(3, "title"), None, st.PARAMS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_overlap_join_against_brute_force(spark):
    c = spark.createDataFrame([("c1", "a", 0, 10), ("c2", "a", 10, 10), ("c3", "a", 5, 5000), ("c4", "b", 0, 9)],
                              "chunk_id string, source_article_id string, char_start int, char_end int")
    m = spark.createDataFrame([("a", "e1", 1, 9, 11), ("a", "e2", 2, 10, 12), ("a", "e3", 3, 7, 7), ("a", "e4", 4, 0, 4999), ("a", "e5", 5, None, None), ("b", "e1", 1, 9, 11)],
                              "article_id string, entity_id string, position int, start_pos int, end_pos int")
    want = sorted((x.chunk_id, y.entity_id) for x in c.collect() for y in m.collect()
                  if y.start_pos is not None and x.source_article_id == y.article_id and y.start_pos < x.char_end and y.end_pos > x.char_start)
    for width in (3, 64, 2048):
        assert sorted((r.chunk_id, r.entity_id) for r in mentions.overlap_join(c, m, width).collect()) == want


def test_overlap_join_plan(spark):
    text = plan(mentions.overlap_join(chunk_articles(st.articles(spark, SF)), st.mentions(spark, SF)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_first_per_key_limits_before_the_shuffle(spark):
    df = keyed.first_per_key(st.table(spark, SF, "documents").select("lang", "doc_id", "text"), ["lang"], ["doc_id"])
    assert "WindowGroupLimit" in plan(df)


def test_extraction_has_no_exchange(spark):
    from pageloom.operators.extract import extract_articles

    text = plan(extract_articles(st.table(spark, SF, "pages")))
    assert "Exchange" not in text.split("== Physical Plan ==")[1]


def test_multi_word_names(spark):
    arts = spark.createDataFrame([("ch1-art1", 1, 1, "The Scope Creep of scope-creep; scope creep, Creep. " + "pad " * 400 + "scope creep")],
                                 "article_id string, chapter_number int, article_number int, markdown_content string")
    names = spark.createDataFrame([("scope creep", "challenge"), ("creep", "concept")], "name string, entity_type string")
    got = mentions.extract_mentions(arts, names).orderBy("start_pos", "end_pos").collect()
    text = arts.first().markdown_content
    assert [r.source_text for r in got if r.name == "scope creep"] == ["Scope Creep", "scope creep", "scope creep"]
    assert all(text[r.start_pos:r.end_pos] == r.source_text for r in got) and sum(r.name == "creep" for r in got) == 5


def test_merge_and_relationships(spark):
    rows = [("ch1-art1", 1, 1, 1, "tool", "Doors", 0, 5, {"vendor": "x", "a": "1"}, "match_fuzzy"),
            ("ch1-art1", 1, 1, 2, "concept", "doors", 9, 14, {}, "exact"),
            ("ch1-art2", 1, 2, 1, "tool", "DOORS ", None, None, {"vendor": "y"}, "no_match")]
    ddl = "article_id string, chapter_number int, article_number int, position int, extraction_class string, extraction_text string, start_pos int, end_pos int, attributes map<string,string>, alignment_status string"
    raw = spark.createDataFrame(rows, ddl).withColumn("attributes", F.transform_values("attributes", lambda _, v: F.array(v)))
    found = mentions.valid_mentions(raw)
    tool = mentions.merge_entities(found).filter("entity_type = 'tool'").first()
    assert (tool["name"], tool["confidence"], tool["attributes"]) == ("Doors", 0.8, {"vendor": "y", "a": "1"})
    links = spark.createDataFrame(
        [("ch1-art1", 1, 1, 1, "used_by", "DOORS", "nobody", "t"), ("ch1-art1", 1, 1, 2, "USED_BY", "doors", "nobody", "again"),
         ("ch1-art1", 1, 1, 3, "guess", "a", "b", "t"), ("ch1-art1", 1, 1, 4, "USED_BY", "a", "", "t")],
        "article_id string, chapter_number int, article_number int, position int, rel_class string, source string, target string, evidence string")
    out = relations.collect_relationships(relations.resolve_relationships(links, found)).collect()
    assert len(out) == 1 and out[0].source_text == "t" and out[0].source_entity_id.startswith("concept-")


def test_contains_join_against_brute_force(spark):
    terms = ["a", "Ab", "abc", "bcde", "zzzz", "", "é", "longer term"]
    texts = ["xabcdey", "ab", "", "a longer term é", "ABC"]
    t = spark.createDataFrame([(x,) for x in terms], "t string")
    x = spark.createDataFrame([(y,) for y in texts], "x string")
    got = sorted((r.t, r.x) for r in gl.contains_join(t, x, "t", "x").collect())
    assert got == sorted((a, b) for a in terms for b in texts if a and a in b)


def test_number_per_key_equals_row_number(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"), "id")
    got = keyed.number_per_key(df, "k", ["id"], F.floor(F.col("id") / 100), "n")
    want = df.selectExpr("k", "id", "row_number() over (partition by k order by id) as n")
    assert got.select("k", "id", "n").exceptAll(want).count() == 0


def test_cosine_grid_equals_broadcast(spark):
    e = st.table(spark, SF, "embeddings")
    v = e.select(F.col("vec_id").alias("id"), "embedding")
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    a, b = vectors.cosine_top_k(q, v, 4), vectors.cosine_top_k(q, v, 4, max_broadcast=10)
    assert a.exceptAll(b).count() == 0 and a.count() == 4 * e.count()


def test_last_filled(spark):
    df = spark.createDataFrame([("e", 1, "a", "x"), ("e", 2, "", None), ("e", 3, "b", "")], "entity_id string, o int, p string, q string")
    row = keyed.last_filled_per_key(df, ["entity_id"], ["o"], ["p", "q"]).first()
    assert (row.p, row.q) == ("b", "x")


def test_build_guide(spark, tmp_path):
    from pageloom.plans.guide import build_guide
    from pageloom.sources.readers import read_guide
    from pageloom.sources.writers import guide_json_lines, write_lines

    out = build_guide(spark, st.guide_pages(spark, SF).drop("chapter_slug"), st.toc(spark, SF), str(tmp_path), st.SITE, st.gazetteer(spark, SF),
                      st.raw_relationships, st.glossary_pages(spark, SF), st.PARAMS)
    assert out["articles"].count() == 200 and out["chunk_stats"].first().total_chunks == out["chunks"].count()
    assert out["embeddings"].count() == out["chunks"].count()
    ids = out["chunks"].select("chunk_id", F.explode("entity_ids").alias("entity_id"))
    assert ids.exceptAll(out["chunk_entities"].select("chunk_id", "entity_id")).count() == 0
    lines = guide_json_lines(st.articles(spark, SF), st.chapters(spark, SF), st.glossary(spark, SF), {"title": "t"})
    write_lines(lines, str(tmp_path / "guide"))
    article = "article_id string, title string, word_count int, markdown_content string"
    back = read_guide(spark, str(tmp_path / "guide"), article)
    assert back.exceptAll(st.articles(spark, SF).select("article_id", "title", F.col("word_count").cast("int"), "markdown_content")).count() == 0
    assert back.count() == 200
    assert {p.name for p in (tmp_path / "graph").iterdir()} >= {"nodes_chapters", "nodes_articles", "nodes_chunks", "rels_contains", "rels_mentions"}


def test_guide_without_names(spark, tmp_path):
    from pageloom.plans.guide import build_guide

    out = build_guide(spark, st.guide_pages(spark, SF).drop("chapter_slug"), st.toc(spark, SF), str(tmp_path), st.SITE)
    chunks = spark.read.json(str(tmp_path / "chunks"))
    assert chunks.count() == out["chunks"].count() and spark.read.json(str(tmp_path / "embeddings")).count() == chunks.count()


def test_null_vectors_and_full_precision(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1e-7]), (3, None)], "id int, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, None)], "query_id int, embedding array<double>")
    for limit in (0, 10):
        rows = vectors.cosine_top_k(q, v, 2, max_broadcast=limit).orderBy("rank").collect()
        assert [(r.query_id, r.id) for r in rows] == [(1, 2), (1, 1)]
    assert [r.id for r in vectors.cosine_top_k(q, v, 2, digits=6).orderBy("rank").collect()] == [1, 2]


def test_shared_folder_is_asked_for_on_a_cluster():
    from pageloom.session import shared_dir

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(spark_master="spark://host:7077"))
    assert shared_dir(Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    local = Session(spark_master="local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_names_of_several_words(spark):
    from pageloom.operators.mentions import extract_mentions, words_with_offsets

    text = "  Oil pump, oil  pump and OIL PUMP; pump oil\nÖl été 3a b4"
    docs = spark.createDataFrame([("a1", 1, 2, text), ("a2", 1, 3, ""), ("a3", 1, 4, None), ("a4", 1, 5, "123 ...")],
                                 "article_id string, chapter_number int, article_number int, markdown_content string")
    names = spark.createDataFrame([("oil pump", "concept"), ("pump", "concept"), ("öl", "concept")], "name string, entity_type string")
    got = [(r.source_text, r.start_pos, r.end_pos) for r in extract_mentions(docs, names).orderBy("start_pos", "name").collect()]
    assert got == [("Oil pump", 2, 10), ("pump", 6, 10), ("pump", 17, 21), ("OIL PUMP", 26, 34), ("PUMP", 30, 34), ("pump", 36, 40), ("Öl", 45, 47)]
    assert all(text[a:b] == s for s, a, b in got)
    words = [(r.source_text, r.start_pos, r.ahead) for r in words_with_offsets(docs, "markdown_content", 1).orderBy("start_pos").collect()]
    assert words[-1] == ("b", 55, ["4"]) and words[0] == ("Oil", 2, [" ", "pump"])
