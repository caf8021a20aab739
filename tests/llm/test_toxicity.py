import zlib

import numpy as np
import pytest

from pageloom.llm import toxicity
from pageloom.llm.queries import QUERIES
from pageloom.llm.toxicity import Reader, fit, inserted, score_texts, similarities, spelled_out, train_on, triple_vectors

DOCS = "doc_id long, text string, score double, row string, toxic int"
LABELS = "doc_id long, quality int, toxic int, text string"


def kernel(a, b):
    """The kernel by its definition, on short words of a-z."""

    def triples(w):
        out = {}
        for i in range(len(w)):
            for k in range(i + 2, min(len(w), i + toxicity.SPAN)):
                for j in range(i + 1, k):
                    u = w[i] + w[j] + w[k]
                    if u.isalpha():
                        out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    x, y = triples(a), triples(b)
    dot = lambda p, q: sum(v * q.get(u, 0) for u, v in p.items())
    return dot(x, y) / max(1e-9, (dot(x, x) * dot(y, y)) ** 0.5)


def test_kernel_by_its_definition():
    words = ["stupid", "st-upid", "stupids", "banana", "anna", "ab", "a", "", "idiotically", "abcabcabc"]
    landmarks = ["stupid", "banana", "idiot"]
    got = similarities(words, np.ascontiguousarray(triple_vectors(landmarks).T))
    assert np.allclose(got, [[kernel(w, m) for m in landmarks] for w in words], atol=1e-5)
    assert got[0, 0] > got[1, 0] > 0.7 > got[3, 0]


def test_letters_and_long_words():
    marks = np.ascontiguousarray(triple_vectors(["idiot"]).T)
    near = similarities(["1d1ot", "ÍDIOT", "qwertzuplkjhgfds" + "idiot" + "mnbvcxylkjhgfdsq", "漢字漢字", "...."], marks)[:, 0]
    assert near[0] > 0.99 and near[1] > 0.99 and near[2] > 0.2 and near[3] == near[4] == 0


def test_spelled_out():
    assert spelled_out("you s t u p i d man a b".split()) == ["you", "stupid", "man", "a", "b"]
    assert inserted("abc") == ["a-bc", "axbc", "ab-c", "abxc"]


def texts(n, seed):
    rng = np.random.default_rng(seed)
    stems = ["thor", "ind", "ble", "sten", "ora", "win", "ead", "lym", "ger", "pol"]
    word = lambda: "".join(rng.choice(stems, 2))
    rows = []
    for _ in range(n):
        y = int(rng.random() < 0.3)
        words = [word() + ("." if rng.random() < 0.1 else "") for _ in range(rng.integers(5, 60))]
        for _ in range(y * rng.integers(1, 4)):
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(["worthless", "stupid", "moron"])))
        rows.append((" ".join(words), y))
    return rows


def test_gapped_insults_are_found():
    train, test = texts(500, 1), texts(300, 2)
    model = fit([t for t, _ in train], np.array([y for _, y in train]))
    reader = Reader(model.landmarks)
    p = lambda rows: model.probability(np.array([max(0.0, float((s @ model.weights).max(initial=0))) for s in reader.sentences(rows)]) + model.bias)
    assert ((p([t for t, _ in test]) >= 0.5) == [y == 1 for _, y in test]).mean() > 0.97
    low, high = p(["thorind blesten.", "sten m.o-ron thor"])
    assert low < 0.5 < high


def test_rows_and_edge_cases(spark):
    rows = [(k, t, y) for k, (t, y) in enumerate(texts(300, 3))]
    docs = [(k, t, 0.0, "x", 0) for k, t, _ in rows]
    docs += [(1000, None, None, None, None), (1001, "", 1.0, "", 1), (None, "you moron", 1.0, "", 1), docs[5], (1002, "moron " + "thorind " * 9000, 0.0, "", 0)]
    labels = [(k, 1, y, "") for k, _, y in rows] + [(3, None, None, ""), (None, 1, 1, ""), (7, 1, rows[7][2], ""), (99999, 1, 1, "")]
    df = spark.createDataFrame(docs, DOCS)
    model = train_on(df, spark.createDataFrame(labels, LABELS))
    got = score_texts(df, model).select("row.doc_id", "row.text", "score").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(((d[0], d[1]) for d in docs), key=repr)
    by = {r.doc_id: r.score for r in got}
    assert all(0 <= s <= 1 for s in by.values())
    assert by[1000] == by[1001] < 0.5 < min(by[None], by[1002])
    assert score_texts(df.where("doc_id < -1"), model).collect() == []


def test_without_two_classes(spark):
    df = spark.createDataFrame([(1, "a b", 0.0, "", 0)], DOCS)
    for labels in ([], [(1, 1, 0, "")], [(1, 1, 1, "")]):
        model = train_on(df, spark.createDataFrame(labels, LABELS))
        assert 0 <= score_texts(df, model).first().score <= 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels if got[r.doc_id].held_out]
    right = sum(p == y for p, y in held) / len(held)
    usual = max(sum(y == 0 for _, y in held), sum(y == 1 for _, y in held)) / len(held)
    assert right >= usual and right > 0.9, (right, usual)


def test_memory_stays_below_its_bound():
    from sys import getsizeof

    from pageloom.llm.common import SLOT, Memo

    rng = np.random.default_rng(1)
    reader = Reader(np.ascontiguousarray(triple_vectors(["idiot", "moron"]).T), room=200_000)
    size = lambda d: sum(getsizeof(k) + SLOT + (0 if v is None else getsizeof(v)) for k, v in d.items())
    plain = Reader(reader.landmarks)
    for _ in range(30):
        texts_ = [" ".join(f"idi{rng.integers(0, 5000)}ot" for _ in range(100)) for _ in range(4)]
        for a, b in zip(reader.sentences(texts_), plain.sentences(texts_)):
            assert np.array_equal(a, b)
        one_batch = 400 * (SLOT + 700)
        assert size(reader.near) <= 200_000 + one_batch and size(reader.old) <= 200_000 + one_batch
        assert all(v is None or v.base is None for v in reader.near.values())
    memo = Memo(lambda w: w.encode() * 2, 50_000)
    for i in rng.integers(0, 3000, 20_000).tolist():
        assert memo[f"w{i}"] == f"w{i}w{i}".encode()
        assert sum(getsizeof(k) + getsizeof(v) + SLOT for k, v in memo.items()) <= 50_000 + 400


def test_one_look_per_kind_of_word(monkeypatch):
    """Words that are one to the kernel are looked at once, and only near ones have their norm taken."""
    looked, normed = [], []
    occurrences, norms = toxicity._occurrences, toxicity._norms
    monkeypatch.setattr(toxicity, "_occurrences", lambda group: looked.append(len(group)) or occurrences(group))
    monkeypatch.setattr(toxicity, "_norms", lambda *a: normed.append(norms(*a)) or normed[-1])
    reader = Reader(np.ascontiguousarray(triple_vectors(["idiot"]).T))
    looked.clear()
    reader.learn({"idiot", "idiot.", "1di0t.", "banana", "banana,", "lllamb"})
    assert sum(looked) == 3 and sum(map(len, normed)) == 1
    assert reader.near["banana"] is None and reader.near["1di0t."][0] == reader.near["idiot"][0] > 0.99


def test_sentences_by_their_definition():
    rng = np.random.default_rng(4)
    words = ["idiot", "idi-ot", "m.oron", "moron!", "banana", "x", ".", "stop.", "qwertzuplkjhgfdsidiotmnbvcxy"]
    texts_ = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 7, 40, 0, 300)] + ["", "banana. x", "idiot " * 5000 + "moron", "moron"]
    marks = np.ascontiguousarray(triple_vectors(["idiot", "moron"]).T)
    got = Reader(marks).sentences(texts_)
    for text, rows in zip(texts_, got, strict=True):
        expected, now = [], []
        for word in [*spelled_out(text.split()), None]:
            if word is not None:
                now.append(similarities([word], marks)[0])
            if now and (word is None or word.endswith((".", "!", "?"))):
                near = [v for v in now if v.max() >= toxicity.NEAR]
                expected += [np.max(near, axis=0)] if near else []
                now = []
        assert np.array_equal(rows, np.array(expected, np.float32).reshape(-1, 2))
    assert all(len(s) == 0 for s in Reader(marks).sentences(["", "banana x"])) and Reader(marks).sentences([]) == []
