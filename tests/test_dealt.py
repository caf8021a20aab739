"""Tables dealt by article: windows, names, links and their groups move no row again, and files of a run are compressed."""

import pytest
from pyspark.sql import functions as F

from pageloom import session
from pageloom.operators.chunks import SECTION, SUMMARY, entity_index, with_entity_ids
from pageloom.operators.graph import chunk_entity_edges, load_counts
from pageloom.operators.mentions import link_mentions
from pageloom.operators.relations import resolve_relationships
from pageloom.operators.vectors import hybrid_lookup
from pageloom.plans import standins as st
from pageloom.session import dealt, light
from pageloom.sources.enriched import read_enriched_guide, write_enriched_guide
from test_enriched import frames

CHUNKS = "chunk_id string, source_article_id string, chunk_type string, char_start int, char_end int"
MENTIONS = "article_id string, chapter_number int, article_number int, position int, entity_id string, name string, source_text string, start_pos int, end_pos int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def apart(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def tables(spark):
    arts = [f"a{i}" for i in range(12)] + [None]
    chunks = [(f"{a}-summary", a, SUMMARY, 0, 9) for a in arts] + [(f"{a}-sec{k}", a, SECTION, 30 * k, 30 * k + 30) for a in arts for k in range(3)]
    names = ["heron", "stork", "crane"]
    mentions = [(a, 1, i, 10 * k, f"tool-{names[(i + k) % 3]}", names[(i + k) % 3], names[(i + k) % 3], 10 * k, 10 * k + 5) for i, a in enumerate(arts) for k in range(9)]
    return spark.createDataFrame(chunks, CHUNKS).repartition(3), spark.createDataFrame(mentions + mentions[:4], MENTIONS).repartition(3)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_rows_stay_and_the_name_goes(spark, tables):
    before = spark.catalog.listTables()
    assert same(dealt(tables[1], "article_id"), tables[1]) and spark.catalog.listTables() == before


def test_links_and_their_groups_stay_where_articles_are(spark, tables, apart):
    chunks, mentions = dealt(tables[0], "source_article_id"), dealt(tables[1], "article_id")
    links, plain = link_mentions(chunks, mentions), link_mentions(*tables)
    counts = [load_counts({"x": (chunk_entity_edges(x, "source_article_id"), ["source_article_id", "src", "dst"])}) for x in (links, plain)]
    for got, want in ((entity_index(links), entity_index(plain)), (with_entity_ids(chunks, links), with_entity_ids(*tables[:1], plain)), counts):
        assert "Exchange hashpartitioning" not in plan(got)
        assert same(got, want)
    assert plan(entity_index(plain)).count("Exchange hashpartitioning") == 2
    assert same(counts[0], load_counts({"x": (chunk_entity_edges(plain), ["src", "dst"])}))


def test_relationships_of_dealt_mentions_do_not_move(spark, tables, apart):
    found = dealt(tables[1], "article_id")
    got = resolve_relationships(st.raw_relationships(found), found)
    assert "Exchange hashpartitioning" not in plan(got)
    assert same(got, resolve_relationships(st.raw_relationships(tables[1]), tables[1])) and got.count() > 0


def test_lookups_move_no_links(spark, tables, apart):
    links = dealt(link_mentions(*tables), "source_article_id")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, embedding array<double>")
    vectors = spark.createDataFrame([("a1-sec0", [1.0, 0.1]), ("a2-sec1", [0.0, 1.0])], "chunk_id string, embedding array<double>")
    got = hybrid_lookup(queries, vectors, links, 1)
    assert "Exchange hashpartitioning" not in plan(got)
    rows = {(r.chunk_id, r.entity_id) for r in links.collect()}
    want = {}
    for q, hit in ((1, "a1-sec0"), (2, "a2-sec1")):
        for c, e in rows:
            if (hit, e) in rows:
                want[q, c] = want.get((q, c), 0) + 1
    assert {(r.query_id, r.chunk_id): r.shared_entities for r in got.collect()} == want


def test_only_small_tables_go_to_all_tasks(spark, tables, monkeypatch, apart):
    chunks = tables[0].select(F.col("source_article_id").alias("article_id"))
    assert "BroadcastHashJoin" in plan(tables[1].join(light(chunks), "article_id"))
    monkeypatch.setattr(session, "SENT", 100)
    assert "BroadcastHashJoin" not in plan(tables[1].join(light(chunks), "article_id"))


def test_a_compressed_guide_is_read_back(spark, tmp_path):
    tables, _ = frames(spark)
    write_enriched_guide(str(tmp_path / "plain"), **tables)
    write_enriched_guide(str(tmp_path / "small"), "gzip", **tables)
    assert list((tmp_path / "small").glob("part-*.gz")) and not list((tmp_path / "plain").glob("part-*.gz"))
    a, b = (read_enriched_guide(spark, str(tmp_path / x)) for x in ("plain", "small"))
    assert all(same(a[k], b[k]) for k in a) and b["mentions"].count() == 3
