"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ by k edits. Split into k + 1 pieces, one piece at least occurs unchanged
in any text that holds the item within k edits. An automaton finds all pieces of all items in one pass over
a text; around each hit Myers' bit-parallel algorithm computes the distance, free at both ends of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import hold_nothing, small_batches
from pageloom.llm.words import slices

#: Edits allowed for each character of an item. At 8 % pieces have about 12 characters, which chance hits seldom meet.
RATE = 0.08
#: Characters of items that one automaton holds; more items are searched block by block.
BLOCK = 1_000_000

LEAKS = "array<struct<item_id:long,distance:int,begin:long,end:long>>"


def normalised(text: str) -> str:
    """Lower case, words joined by one blank."""
    return " ".join(text.lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def symbol_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def distances(masks: dict[str, int], m: int, text: str) -> Iterator[int]:
    """For every end in the text, the fewest edits between the item and a stretch that ends there."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    get = masks.get
    for c in text:
        equal = get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up <<= 1
        plus = full & ((down << 1) | ~(vertical | up))
        minus = full & up & vertical
        yield score


class Matcher:
    """All items of one block."""

    def __init__(self, items: tuple[tuple[int, str], ...], rate: float):
        import ahocorasick

        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normalised(text)
            k = int(rate * len(item))
            number = len(self.items)
            self.items.append((item_id, item, k, symbol_masks(item)))
            for place, piece in pieces(item, k):
                found.setdefault(piece, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def match(self, text: str) -> list[dict]:
        """The best match of each item within its budget; spans are places in the normalised text."""
        text = normalised(text)
        spans: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.automaton.iter(text) if len(self.automaton) else ():
            for number, place in places:
                _, item, k, _ = self.items[number]
                low = end - length + 1 - place - k
                high = low + len(item) + 2 * k
                mine = spans.setdefault(number, [])
                if mine and low <= mine[-1][1]:
                    mine[-1][1] = max(mine[-1][1], high)
                    mine[-1][0] = min(mine[-1][0], low)
                else:
                    mine.append([low, high])
        best: dict[int, dict] = {}
        for number, stretches in spans.items():
            item_id, item, k, masks = self.items[number]
            for low, high in stretches:
                low = max(0, low)
                for at, d in enumerate(distances(masks, len(item), text[low : max(0, high)])):
                    if d <= k and (number not in best or d < best[number]["distance"]):
                        best[number] = {"item_id": item_id, "distance": d, "end": low + at + 1}
            if number in best:
                hit = best[number]
                # the same backwards from the end gives the place where the stretch begins
                back = text[max(0, hit["end"] - len(item) - k) : hit["end"]][::-1]
                least = min(enumerate(distances(symbol_masks(item[::-1]), len(item), back)), key=lambda x: (x[1], abs(x[0] + 1 - len(item))))
                hit["begin"] = hit["end"] - least[0] - 1
        return sorted(best.values(), key=lambda h: (h["item_id"], h["distance"]))


@lru_cache(maxsize=2)
def matcher(items: tuple[tuple[int, str], ...], rate: float) -> Matcher:
    return Matcher(items, rate)


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[tuple[int, str], ...]]:
    """Items in blocks of bounded size, read one after the other. Null, empty or id-less ones match nothing."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null").distinct()
    block, size = [], 0
    for row in rows.orderBy("i", "t").toLocalIterator():
        if not normalised(row["t"]):
            continue
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= BLOCK:
            yield tuple(block)
            block, size = [], 0
    if block:
        yield tuple(block)


def marked(
    docs: DataFrame, items: DataFrame, rate: float = RATE, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(row, leaks)``: every row of ``docs`` as a struct, with its array of items found.

    A text holds an item when some stretch of it is at most ``floor(rate * length)`` edits from the item,
    both in lower case with single blanks. Each item is given once, with its least distance and the span in
    the normalised text; items that share an id are given each. Null and empty texts hold nothing, and an
    empty items table finds nothing. All rows and columns stay as they are, repeated and null ones too.

    There is no shuffle. Items are sent to the tasks in blocks of about a million characters."""
    small_batches(docs.sparkSession)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"), F.expr(f"cast(array() as {LEAKS})").alias("leaks"))
    shape = T.StructType([*df.schema.fields[:2], T.StructField("leaks", T.ArrayType(T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])))])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())]))
    for block in _blocks(items, item_id_col, item_text_col):

        def find(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            hold_nothing()
            match = matcher(block, rate).match
            for batch in batches:
                for part in slices(batch, 1):
                    before = part.column(2).to_pylist()
                    leaks = [(old or []) + (match(t) if t else []) for old, t in zip(before, part.column(1).to_pylist())]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(leaks, kind)], ["row", "text", "leaks"])

        df = df.mapInArrow(find, shape)
    return df.select("row", "leaks")


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, id_col: str = "doc_id", **columns) -> DataFrame:
    """``(id, item_id, distance, begin, end)``: one row for each row of ``docs`` and item it holds; see ``marked``."""
    found = marked(docs, items, rate, **columns).select(F.col("row")[id_col].alias("id"), F.explode("leaks").alias("leak"))
    return found.select("id", "leak.*")


def without_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, **columns) -> DataFrame:
    """The rows of ``docs`` that hold no item; see ``marked``."""
    return marked(docs, items, rate, **columns).where(F.size("leaks") == 0).select("row.*")
