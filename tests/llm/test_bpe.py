import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm.bpe import MergeCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n_bytes string, id string"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_as_the_library(library):
    count = MergeCounter(PATH, memo=50).count
    rng = random.Random(7)
    marks = [*"ab 'stlrvemd  \n\t\r\x0b\x0c\x1c\x85\xa0\u2003\u200b\u2028\ufeff\u180e1२é,.!😀漢\u0301\xad", "<|endoftext|>", "'ll", "the ", "  \n"]
    for _ in range(3000):
        text = "".join(rng.choices(marks, k=rng.randint(0, 30)))
        assert count(text) == library(text), repr(text)
    long = "".join(rng.choices("aab", k=50_000))
    assert count(long) == library(long)


def test_query_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "é"), (3, "é"), (None, "a b"), (4, "the word " * 3000), (5, "<|endoftext|>")]
    got = token_counts(spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA), PATH).collect()
    want = [(i, len((t or "").encode()), library(t), library(t) > 1024) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_no_shuffle(spark, capsys):
    token_counts(spark.createDataFrame([(1, "a", "x", "y")], SCHEMA), PATH).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_other_tokenizers_are_refused():
    import public_tokenizers

    from pageloom.llm.packing import Encoder

    for make in (MergeCounter, Encoder):
        with pytest.raises(ValueError, match="standard cutting rules"):
            make(public_tokenizers.path("word_bpe_49k.json"))
