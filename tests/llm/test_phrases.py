import random

import pytest

from pageloom.llm import phrases
from pageloom.llm.phrases import collocations, phrase_counts

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, rank int"


def pieces_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in ".,;:!?\n\x0b\x0c\r":
        text = text.replace(c, "\n")
    return [[w for w in p.replace("\t", " ").split(" ") if w] for p in text.split("\n")]


def counted(rows):
    f, n = {}, {}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] = n.get(lang, 0) + len(words)
            for size in range(1, 5):
                for s in range(len(words) - size + 1):
                    key = lang, tuple(words[s : s + size])
                    f[key] = f.get(key, 0) + 1
    return f, n


def brute_force(rows, least, top, share):
    f, n = counted(rows)
    out = {}
    many = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in many.items():
        if any(lo == lang and len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (lo, q), b in many.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, rest, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, rest) in enumerate(sorted(found)[:top]))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in collocations(df.repartition(5), **kw).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "The", "of", "new", "york", "city", "é", "ÉT", "hall", "x\x00y", "и", "a-b"]
    gaps = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", " ;: ", "\x0b", "\x0c!", "?", "…", " ", "\x1c"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "de", None, "und", "en us", ""])))
    rows += [(400 + i, rows[5][1], "en") for i in range(40)] + [rows[7]] * 3
    rows += [(500, None, "en"), (501, "", None), (502, "...,,;", "en"), (503, "   \t ", "en"), (None, "new york city hall " * 50, None)]
    return rows


@pytest.mark.parametrize("period", [1, 3, 64])
def test_against_brute_force(spark, rows, period):
    f, n = counted(rows)
    got, sizes = phrase_counts(spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA), 2, 4, period)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in got.collect()} == {k: a for k, a in f.items() if a >= 2}
    assert {r.lang: r.n for r in sizes.collect()} == {k: v for k, v in n.items() if v}


@pytest.mark.parametrize("top, share", [(2000, 80), (5, 80), (2000, 100)])
def test_ranks(spark, rows, top, share):
    assert run(spark, rows, least=6, top=top, share=share) == brute_force(rows, 6, top, share)


def test_long_text_in_small_runs(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RUN", 50)
    rng = random.Random(9)
    rows = [(1, " ".join(rng.choice("a b c d e".split()) for _ in range(200_000)), "en"), (2, "z " * 3000, "en"), (3, "q" * 2_000_000, "en")]
    assert run(spark, rows, least=100) == brute_force(rows, 100, 2000, 80)


def test_full_bitmap_changes_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 64)
    assert run(spark, rows, least=6) == brute_force(rows, 6, 2000, 80)


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None), (2, "one two", "en")]) == []


def test_chunks_cover_every_phrase_once():
    import pyarrow as pa

    text = " ".join(f"w{i * i % 97}" for i in range(3000))
    chunks, rows, shared = phrases.parse(pa.array([text, None, "", "one"]), 4, 8)
    back = []
    for chunk, s in zip(chunks.to_pylist()[:-1], shared.tolist()):
        words = chunk.split(" ")
        back += words[: len(words) - s]
    assert back == text.split(" ")
    assert rows.tolist()[-1] == 3 and chunks.to_pylist()[-1] == "one" and len(chunks) > 200
