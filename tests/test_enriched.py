"""The enriched guide: a JSON document that a plain reader takes, and tables that come back equal."""

import json

import pytest

from pageloom.sources.enriched import enriched_guide_lines, read_enriched_guide
from pageloom.sources.writers import write_lines

PLACE = "name string, source_text string, start_pos int, end_pos int, confidence double, attributes map<string,string>, alignment_status string"
REL = "relationship_id string, relationship_type string, source_entity_id string, target_entity_id string, source_text string, source_article_id string, position int, confidence double"


def frames(spark, empty=False):
    odd = 'a "quoted"\\ name,\nline\r  {"article_id"'
    mentions = [("a1", "e1", "tool", p, "Heron", odd, p, None, 1.0, {"k": odd}, None, "extra") for p in (5, 5, 0)] + [
        ("gone", "e1", "tool", 0, "x", "x", 0, 1, 1.0, None, "exact", "extra"), (None, "e1", "tool", 0, "x", "x", 0, 1, 1.0, None, "exact", "extra")]
    rels = [("r1", "USES", "e1", "e2", odd, "a1", 4, 1.0), ("r2", "USES", "e1", "e2", None, "a1", 4, 1.0), ("r1", "USES", "e1", "e2", odd, "gone", 1, 1.0)]
    tables = {
        "articles": spark.createDataFrame([("a1", 1), ("a1", 1), ('b"2', 2), (None, 3)], "article_id string, seq int"),
        "enrichment": spark.createDataFrame([("a1", odd, 2), ("a1", odd, 2), ("none", "x", 1)], "article_id string, summary string, extraction_passes int"),
        "mentions": spark.createDataFrame(mentions, f"article_id string, entity_id string, entity_type string, position int, name string, source_text string, start_pos int, end_pos int, confidence double, attributes map<string,string>, alignment_status string, line string"),
        "entities": spark.createDataFrame([('e"1', "tool", "a1", "Heron", odd, 0, 5, 1.0, {"k": odd}, "exact"), ("e2", "role", "a1", "", "", None, None, 0.5, None, None)], f"entity_id string, entity_type string, source_article_id string, {PLACE}"),
        "article_relationships": spark.createDataFrame(rels, REL),
        "relationships": spark.createDataFrame(rels[:2], REL),
        "glossary": spark.createDataFrame([(2, "b", ["x"], [1], []), (1, odd, None, [], ["e1"]), (1, odd, None, [], ["e1"])], "seq int, term string, related_terms array<string>, related_chapters array<int>, related_entity_ids array<string>"),
    }
    return ({k: v.where("false") for k, v in tables.items()} if empty else {k: v.repartition(3) for k, v in tables.items()}), odd


def document(path):
    return json.loads("\n".join(p.read_text() for p in sorted(path.glob("part-*"))))


def test_document_and_back(spark, tmp_path):
    tables, odd = frames(spark)
    write_lines(enriched_guide_lines(**tables, config={"passes": 2}, extracted_at="2024-02-29"), str(tmp_path / "g"))
    doc = document(tmp_path / "g")
    assert set(doc["article_enrichments"]) == {"a1", 'b"2'} and set(doc["entities"]) == {'e"1', "e2"}
    one = doc["article_enrichments"]["a1"]
    assert one["summary"] == odd and one["extraction_passes"] == 2 and one["entity_count"] == 3 and one["relationship_count"] == 2
    assert [e["start_pos"] for e in one["entities"]] == [0, 5, 5] and one["entities"][0]["attributes"] == {"k": odd}
    assert doc["article_enrichments"]['b"2']["entities"] == [] and [t["term"] for t in doc["glossary_enrichments"]] == [odd, odd, "b"]
    assert (doc["entity_count"], doc["relationship_count"], doc["article_count"], doc["extraction_config"], doc["extracted_at"]) == (2, 2, 2, {"passes": 2}, "2024-02-29")
    back = read_enriched_guide(spark, str(tmp_path / "g"))
    assert {k: v.count() for k, v in back.items()} == {
        "articles": 2, "mentions": 3, "entities": 2, "article_relationships": 2, "relationships": 2, "glossary": 3, "unread": 0}
    for name in ("entities", "relationships", "glossary"):
        given = [tuple(r[c] for c in back[name].columns) for r in tables[name].collect()]
        assert sorted(map(repr, given)) == sorted(repr(tuple(r)) for r in back[name].collect())
    assert back["articles"].where("article_id = 'a1'").first().summary == odd


def test_empty_tables(spark, tmp_path):
    write_lines(enriched_guide_lines(**frames(spark, empty=True)[0]), str(tmp_path / "g"))
    doc = document(tmp_path / "g")
    assert doc["article_enrichments"] == {} and doc["entities"] == {} and doc["relationships"] == [] and doc["article_count"] == 0


@pytest.mark.parametrize("damage", ['{"term":"cut off', "not a line of the document"])
def test_lines_that_do_not_parse_are_reported(spark, tmp_path, damage):
    tables, _ = frames(spark)
    lines = enriched_guide_lines(**tables).select("line").union(spark.createDataFrame([(damage,)], "line string"))
    lines.write.text(str(tmp_path / "g"))
    back = read_enriched_guide(spark, str(tmp_path / "g"))
    assert [r.line for r in back["unread"].collect()] == [damage] and back["glossary"].count() == 3
