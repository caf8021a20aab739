"""One call writes every export, with the summaries of an enrichment."""

import json

from pyspark.sql import functions as F

from pageloom.plans import standins as st
from pageloom.plans.guide import build_guide
from pageloom.sources.enriched import read_enriched_guide
from pageloom.sources.readers import read_guide

SF = "/root/testdata/sf0.001"


def text(path):
    return "\n".join(p.read_text() for p in sorted(path.glob("part-*.txt")))


def test_all_exports(spark, tmp_path):
    toc = st.toc(spark, SF)
    extra = toc.limit(1).withColumns({"article_number": F.lit(9999), "article_slug": F.lit("never-fetched")})
    build = dict(params=st.PARAMS, enrichment=st.enrichment(spark, SF), title="The Guide", publisher="Example", scraped="2024-02-29")
    out = build_guide(spark, st.guide_pages(spark, SF).drop("chapter_slug"), toc.unionByName(extra), str(tmp_path), st.SITE, st.gazetteer(spark, SF),
                      st.raw_relationships, st.glossary_pages(spark, SF), **build)
    assert [r.article_number for r in out["missing_pages"].collect()] == [9999]
    summaries = {r.article_id: r.summary for r in st.enrichment(spark, SF).collect()}
    count = {name: df.count() for name, df in out.items()}

    guide = json.loads(text(tmp_path / "guide"))
    arts = [a for c in guide["chapters"] for a in c["articles"]]
    assert guide["total_articles"] == len(arts) == count["articles"] == 200
    assert guide["total_word_count"] == sum(a["word_count"] for a in arts) == sum(c["total_word_count"] for c in guide["chapters"])
    assert {a["article_id"]: a["summary"] for a in arts if a["summary"] is not None} == summaries
    assert guide["glossary"]["term_count"] == len(guide["glossary"]["terms"]) == count["glossary"]
    assert all({"acronym", "related_terms", "related_chapters"} >= set(t) - {"term", "definition"} for t in guide["glossary"]["terms"])
    back = read_guide(spark, str(tmp_path / "guide"), "article_id string, summary string, markdown_content string, word_count bigint")
    assert back.exceptAll(out["articles"].select("article_id", "summary", "markdown_content", F.col("word_count").cast("bigint"))).count() == 0

    enriched = json.loads(text(tmp_path / "enriched_guide"))
    assert enriched["article_count"] == 200 and enriched["entity_count"] == count["entities"]
    assert enriched["relationship_count"] == count["relationships"] > 0
    assert sum(a["entity_count"] for a in enriched["article_enrichments"].values()) == count["mentions"]
    assert {k: a["summary"] for k, a in enriched["article_enrichments"].items() if a["summary"] is not None} == summaries
    read = read_enriched_guide(spark, str(tmp_path / "enriched_guide"))
    assert read["article_relationships"].count() == count["found_relationships"] and read["unread"].count() == 0

    records = [json.loads(line) for p in (tmp_path / "records").glob("part-*") for line in p.read_text().splitlines()]
    assert [r["type"] for r in records].count("article") == 200 and [r["type"] for r in records].count("glossary_term") == count["glossary"]
    assert "*Scraped on 2024-02-29*" in text(tmp_path / "book")
    statements = text(tmp_path / "statements")
    assert statements.count("CREATE (:Article ") == 200 and statements.count("CREATE (:GlossaryTerm ") == count["glossary"]
    assert text(tmp_path / "chunk_statements").count("CREATE (:Chunk ") == count["chunks"]
    nodes = spark.read.csv(str(tmp_path / "graph" / "nodes_articles"), header=True, multiLine=True, escape='"')
    assert nodes.filter("summary <> ''").count() == sum(1 for s in summaries.values() if s)


def test_exports_without_names(spark, tmp_path):
    build_guide(spark, st.guide_pages(spark, SF).drop("chapter_slug"), st.toc(spark, SF), str(tmp_path), st.SITE)
    enriched, guide = json.loads(text(tmp_path / "enriched_guide")), json.loads(text(tmp_path / "guide"))
    assert enriched["entities"] == {} and enriched["article_count"] == guide["total_articles"] == 200 and guide["glossary"]["terms"] == []
    assert text(tmp_path / "statements").count("CREATE (:Entity") == 0
