"""Bitmaps of many places, filled by the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the blocks in which a bitmap comes to the driver (32 KB).
BLOCK = 1 << 18


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """``bits / 8`` bytes with a bit for each value of the column ``at``, which is below ``bits``, a power of two.

    The executors fill whole blocks, and the driver takes in the blocks of one task after the other: it holds the bitmap and
    no rows of single places, however many there are. Blocks without a place do not come."""
    size = max(64, min(bits, BLOCK))
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("set"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            word, sets = (np.asarray(batch.column(i), np.int64) for i in range(2))
            block, place = word // (size // 64), word % (size // 64)
            for b in np.unique(block).tolist():
                mine = block == b
                blocks.setdefault(b, np.zeros(size // 64, np.int64))[place[mine]] = sets[mine]
        for b, filled in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([filled.tobytes()], pa.binary())], ["block", "filled"])

    rows = words.repartition(F.shiftright("word", (size // 64).bit_length() - 1)).mapInArrow(fill, "block long, filled binary")
    out = np.zeros(max(bits, 64) // 8, np.uint8)
    for r in rows.toLocalIterator():
        out[r["block"] * (size // 8) : (r["block"] + 1) * (size // 8)] = np.frombuffer(r["filled"], np.uint8)
    return out
