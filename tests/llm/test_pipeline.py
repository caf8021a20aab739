import hashlib

import pytest
from test_jaccard import brute_force as near
from test_packing import verify

import corpus_pipeline
from pageloom.llm.leaks import RATE, distances, normalised, symbol_masks
from pageloom.llm.substrings import brute_force as repeats
from pageloom.llm.toxicity import Reader, train_on
from pageloom.session import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).select("lang", "source")
    lang, source = extra.first()
    added = [(9001, None, lang, source, None), (9002, "", lang, source, 0), (None, "no id here", lang, source, 10), (9003, "you worthless stupid pathetic moron.", lang, source, 30)]
    docs = docs.union(spark.createDataFrame(added, docs.schema)).union(docs.where("doc_id = 3")).withColumns({"component": docs["lang"], "row": docs["doc_id"]})
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF)))
        assert out[-1].columns == docs.columns or len(out) == 6
    return out


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "best-fit packing"]


def test_toxic_documents_go(spark, steps):
    model = train_on(steps[0], spark.read.parquet(f"{SF}/labels.parquet"), most=1000)
    reader = Reader(model.landmarks)
    bad = lambda t: model.probability(max(0.0, float((reader.sentences([t or ""])[0] @ model.weights).max(initial=0))) + model.bias) >= 0.5
    assert pairs(steps[1]) == [(i, t) for i, t in pairs(steps[0]) if not bad(t)]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = [labels[i] for i, _ in pairs(steps[1]) if i in labels]
    # eleven labels teach little; test_toxicity.py measures accuracy on a larger table
    assert sum(left) < sum(labels.values()) and len(left) - sum(left) >= 0.9 * sum(y == 0 for y in labels.values())


def test_one_of_each_near_group_stays(steps):
    component = {i: c for i, _, c in near(pairs(steps[1]))}
    assert pairs(steps[2]) == [(i, t) for i, t in pairs(steps[1]) if component[i] == i]
    assert steps[2].count() < steps[1].count()


def test_repeated_windows_go(steps):
    want = []
    for (i, t), (j, _, removed, digest) in zip(pairs(steps[2]), repeats(pairs(steps[2]))):
        assert i == j
        want.append((i, removed, digest if removed else hashlib.sha256((t or "").encode()).hexdigest()))
    before = dict(pairs(steps[2]))
    got = [(i, 0 if before[i] == t else len(before[i].encode().split()) - len(t.split(" ") if t else []), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in pairs(steps[3])]
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(n for _, n, _ in want) > 0
    assert all(r.n_chars == len(r.text) for r in steps[3].where("text is not null and doc_id <> 9003").collect())
    assert {r.row for r in steps[3].collect()} == {r.doc_id for r in steps[3].collect()}


def test_leaked_items_go(spark, steps):
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def dirty(text):
        text = normalised(text or "")
        return any(item in text or any(d <= int(RATE * len(item)) for d in distances(symbol_masks(item), len(item), text)) for item in items)

    assert pairs(steps[4]) == [(i, t) for i, t in pairs(steps[3]) if not dirty(t)]


def test_all_that_is_left_is_packed(spark, steps):
    got = [tuple(r) for r in steps[5].select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    verify(spark, pairs(steps[4]), got, 1024)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < -1")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
    assert docs.count() == 0


def test_rows_of_one_text_keep_their_columns(spark):
    rows = [(1, "same text", "en", "a", 9), (1, "same text", "de", "b", 9), (2, "w " * 30, "fr", "c", 60), (3, "w " * 30, "es", None, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.lang, r.source) for r in corpus_pipeline.substring_dedup(spark, docs, SF).collect()), key=repr)
    assert got == sorted(((i, lang, source) for i, _, lang, source, _ in rows), key=repr)
