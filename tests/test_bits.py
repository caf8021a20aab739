"""Bitmaps come to the driver as blocks of bytes, not as rows of single places."""

import numpy as np
import pytest

from pageloom.functions import bits
from pageloom.llm import phrases


@pytest.mark.parametrize("size", [32, 1 << 12, 1 << 22])
def test_every_place_is_set_and_no_other(spark, size):
    rng = np.random.default_rng(size)
    places = np.unique(np.append(rng.integers(0, size, 3000), [0, size - 1]))
    filled = bits.bitmap(spark.createDataFrame([(int(p),) for p in [*places, *places[:50]]], "at long").repartition(5), size)
    assert np.array_equal(np.flatnonzero(np.unpackbits(filled, bitorder="little")), places)
    assert not bits.bitmap(spark.createDataFrame([], "at long"), size).any()


def test_frequent_pairs_come_as_blocks(spark, monkeypatch):
    """One row for each set word of the bitmap once filled the driver; a full bitmap had four million of them."""
    frame = type(spark.range(1))
    seen, plain = [], frame.toLocalIterator
    monkeypatch.setattr(frame, "toPandas", lambda *_: pytest.fail("rows of places in the driver"))
    monkeypatch.setattr(frame, "toLocalIterator", lambda df, *a: (seen.append(r) or r for r in plain(df, *a)))
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    filled = phrases.bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"), 1 << 20)
    assert phrases._has(filled, keys.astype(np.int64).view(np.uint64), 1 << 20).all()
    assert len(seen) == 4 and filled.nbytes == 1 << 17 and np.bitwise_count(filled).sum() <= 40_000
