"""Other types go before names are looked up, chunk texts are written once, and first names need no sort of all mentions."""

from pageloom.operators import relations as rl
from pageloom.operators.mentions import entity_names, merge_entities
from pageloom.plans import standins as st
from pageloom.plans.checks import QUERIES, graph, whole

SF = "/root/testdata/sf0.001"
MENTIONS = (
    "entity_id string, entity_type string, name string, source_text string, start_pos int, end_pos int, article_id string, alignment_status string, "
    "chapter_number int, article_number int, position int, confidence double, attributes map<string,string>")


def test_only_the_asked_type_is_resolved(spark, monkeypatch):
    seen, plain = [], rl.resolve_relationships
    monkeypatch.setattr(rl, "resolve_relationships", lambda raw, found: (seen.append(raw), plain(raw, found))[1])
    got = QUERIES["relationships_by_type"](spark, SF)
    assert {r[0] for r in seen[0].select("rel_class").distinct().collect()} == {"requires"}
    found = graph.mentions_between(spark, SF)
    every = rl.collect_relationships(plain(st.raw_relationships(found), found)).where("relationship_type = 'REQUIRES'")
    want = every.select("relationship_id", "source_text")
    assert want.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_chunk_texts_are_written_once(spark, monkeypatch):
    seen, plain = [], whole.written
    monkeypatch.setattr(whole, "written", lambda df, *tag: (seen.append(df.columns), plain(df, *tag))[1])
    counts = {r["name"]: r["n"] for r in QUERIES["export_all"](spark, SF).collect()}
    assert sum("text" in columns for columns in seen) == 1
    assert counts["chunks"] == counts["embeddings"] == counts["nodes_chunks"] and counts["entity ids of chunks"] == counts["rels_chunk_entity"]


def test_first_names_without_a_sort_of_all_mentions(spark):
    places = [(2, 1, 5), (1, 9, 7), (1, 9, -3), (1, 2, 2**31 - 1), (1, None, 4), (None, 5, 5), (2, None, 1), (-4, 3, 3)]
    rows = [(e, "role", f"{e}{i}", "x", 0, 1, f"a{i}", "match_exact", *p, 1.0, {}) for e, own in
            (("p", places[:4]), ("q", places), ("r", places[:1]), ("s", places[4:7]), (None, places[1:3])) for i, p in enumerate(own)]
    mentions = spark.createDataFrame(rows + rows[:3], MENTIONS).repartition(3)
    got, want = entity_names(mentions), merge_entities(mentions).select("entity_id", "name")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert any("HashAggregate(keys=[entity_id" in line and "partial_min(" in line for line in plan.splitlines())
