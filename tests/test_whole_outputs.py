from __spark_entry__ import QUERIES
from pageloom.sources.writers import HEADERS

SF = "/root/testdata/sf0.001"


def test_all_lines_and_files(spark):
    keys = {name: {r["k1"] for r in QUERIES[name](spark, SF).select("k1").distinct().collect()}
            for name in ("graph_statements", "chunk_statements", "book_lines")}
    assert keys["graph_statements"] == {0, 10, 11, 20, 21, 30, 31, 40, 41, 50, 51, 60, 61, 70, 71}
    assert keys["chunk_statements"] == set(range(6)) and keys["book_lines"] == set(range(6))
    counts = {r["name"]: r["n"] for r in QUERIES["export_all"](spark, SF).collect()}
    assert set(counts) == {*HEADERS, "chunks", "embeddings", "entity ids of chunks"} and all(counts.values())
