"""Best-fit packing by bin completion with branch and bound.

Lengths are whole numbers up to the capacity, so the packing problem is a histogram with at most that many
entries, whatever the size of the corpus. It is solved on the driver as patterns with repeat counts; the
pieces then find their places by their rank among pieces of their length, in Spark.

The search takes the largest length left, enumerates the undominated fillings of the room beside it, of any
number of pieces, and uses a filling as often as the counts allow, then less often. A branch ends when its
waste exceeds what the best solution so far leaves. Best-fit decreasing gives the first solution and one
more at every node of the search. Only the number of nodes bounds it.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.bpe import PIECES, byte_level, byte_symbols
from pageloom.llm.common import Memo, hold_alone, small_batches
from pageloom.llm.words import slices
from pageloom.session import written

#: Blanks and line feeds that do not stand alone between two words.
UNEVEN = r"[ \n][ \n]|\A[ \n]|[ \n]\z"
#: Anything else that some library takes for white space.
OTHER_BLANK = r"[\t\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

#: (lengths of one sequence as (length, times) pairs, number of such sequences)
Pattern = tuple[tuple[tuple[int, int], ...], int]


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers; one for each Python worker and tokenizer file.

    The ids are the library's. A text whose white space is single blanks and line feeds is taken apart at it, as
    the tokenizer does; each part falls into pieces, whose ids the library's model gives, and parts are kept by
    value. Any other text is encoded by the library as it is."""

    def __init__(self, path: str, memo: int = 80 << 20, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        byte_level(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = regex.compile(PIECES)
        self.symbols = dict(enumerate(byte_symbols()))
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([OTHER_BLANK, UNEVEN, *map(re.escape, specials)])
        #: words by value: one that a blank or line feed comes before, and one that begins a text
        self.inner = Memo(self.ids_after_space, memo, longest)
        self.first = Memo(self.ids_of_part, memo >> 3, longest)
        self.stops = {c: self.ids_of_part(c) for c in ".,"}
        assert sys.byteorder == "little" and array("I").itemsize == 4

    def ids_of_piece(self, piece: str) -> bytes:
        symbols = piece.encode("utf-8").decode("latin-1").translate(self.symbols)
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def ids_of_part(self, part: str) -> bytes:
        return b"".join(map(self.ids_of_piece, self.pieces.findall(part)))

    def ids_after_space(self, word: str) -> bytes:
        if word.isalpha():
            return self.ids_of_piece(" " + word)
        if word[0] == "\n":
            return self.ids_of_part(word)
        # a comma or full stop after letters is a piece of its own
        if word[-1] in self.stops and word[:-1].isalpha():
            return self.inner[word[:-1]] + self.stops[word[-1]]
        return self.ids_of_part(" " + word)

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = pa.compute.fill_null(column, "")
        out = []
        for text, odd in zip(column.to_pylist(), pa.compute.match_substring_regex(column, self.odd).to_pylist()):
            if not text or odd:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"))
            else:
                head, *words = text.replace("\n", " \n").split(" ")
                out.append(np.frombuffer(self.first[head] + b"".join(map(self.inner.__getitem__, words)), "<u4"))
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_into_pieces(path: str, capacity: int, end_id: int):
    """``(id, text)`` to ``(id, piece, start, length, ids_crc32)``. Of a longer document the first piece is the shorter one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_alone("packing", encoder.cache_clear)
        for batch in batches:
            for part in slices(batch, 1):
                rows: list[tuple] = []
                close = np.array([end_id], "<u4")
                for i, ids in enumerate(encoder(path).encode(part.column(1))):
                    ids = np.concatenate([ids, close])
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    rows += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                place, *rest = (np.array(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(place)), *(pa.array(x, t) for x, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64())))],
                    ["id", "piece", "start", "length", "ids_crc32"])

    return cut


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram: bins that are alike are kept as one pattern with a number."""
    open_bins: dict[int, list[list]] = {}  # room left -> [pattern, bins]
    done: list[Pattern] = []
    for size in sorted(counts, reverse=True):
        n = counts[size]
        rooms = sorted(r for r in open_bins if r >= size)
        for room in [*rooms, capacity]:
            if not n:
                break
            fits = room // size
            bins = open_bins.pop(room) if room in rooms else [[(), -(-n // fits)]]
            left = []
            for pattern, m in bins:
                full = min(m, n // fits)
                n -= full * fits
                if full:
                    open_bins.setdefault(room - fits * size, []).append([(*pattern, (size, fits)), full])
                if m > full and 0 < n < fits:
                    open_bins.setdefault(room - n * size, []).append([(*pattern, (size, n)), 1])
                    full, n = full + 1, 0
                if m > full and pattern:
                    left.append([pattern, m - full])
            if left:
                open_bins.setdefault(room, []).extend(left)
        done += [(tuple(p), m) for p, m in open_bins.pop(0, [])]
    return done + [(tuple(p), m) for bins in open_bins.values() for p, m in bins]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by volume, and with lengths over half the capacity set apart."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    for small in sorted({s for s in counts if 2 * s <= capacity} | {0}):
        alone = sum(n for s, n in counts.items() if s > capacity - small)
        large = {s: n for s, n in counts.items() if capacity - small >= s > capacity / 2}
        rest = sum(s * n for s, n in counts.items() if capacity / 2 >= s >= small)
        room = sum((capacity - s) * n for s, n in large.items())
        best = max(best, alone + sum(large.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def larger_fillings(counts: dict[int, int], room: int, slack: int) -> Iterator[tuple[int, ...]]:
    """Sets of three and more lengths, of any number, that leave at most ``slack`` of the room and no room for a
    length not used, those of long lengths first.

    ``sums[k]`` has the bits of all sums of the ``k`` smallest lengths, so each step taken leads to a filling."""
    sizes = sorted(counts)
    whole = (1 << (room + 1)) - 1
    sums = [1]
    for s in sizes:
        reach, more, n = sums[-1], 1, min(counts[s], room // s)
        while n > 0:
            more = min(more, n)
            reach |= (reach << (s * more)) & whole
            n, more = n - more, 2 * more
        sums.append(reach)

    def further(taken: tuple[int, ...], left: int, k: int, slack: int) -> Iterator[tuple[int, ...]]:
        if not k or left < sizes[0]:
            if len(taken) > 2:
                yield taken
            return
        for j in range(k - 1, -1, -1):
            s = sizes[j]
            for n in range(min(counts[s], left // s), 0, -1):
                rest = left - n * s
                most = min(slack, s - 1) if n < counts[s] else slack
                low = max(0, rest - most)
                if (sums[j] >> low) & ((1 << (rest - low + 1)) - 1):
                    yield from further(taken + (s,) * n, rest, j, most)
            slack = min(slack, s - 1)  # from here on this length stays out, so it may not fit at the end

    if sizes:
        yield from further((), room, len(sizes), slack)


def fillings(counts: dict[int, int], room: int, slack: int, few: bool = False) -> Iterator[tuple[int, ...]]:
    """Undominated sets of lengths that leave at most ``slack`` of the room: single lengths, pairs, then those of
    any larger number, or with ``few`` only those of three and four.

    With all but the last length given, only the largest last one is undominated. A pair also has to hold
    a longer second length than the pairs with a longer first one, and more than the best single length."""
    mask = sum(1 << s for s in counts)

    def largest(most: int) -> int:
        return (mask & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else -1

    single = largest(room)
    if single < 1:
        if room <= slack:
            yield ()
        return
    if room - single <= slack:
        yield (single,)
    pairs, a, last = [], single, 0
    while a >= 1 and 2 * a >= room - slack:
        b = largest(min(a if counts[a] > 1 else a - 1, room - a))
        if b > last and a + b > single:
            last = b
            if room - a - b <= slack:
                pairs.append((a, b))
        a = largest(a - 1)
    yield from sorted(pairs, key=lambda p: (-sum(p), -p[0]))

    def deeper(taken: tuple[int, ...], left: int, many: int) -> Iterator[tuple[int, ...]]:
        last = taken[-1] if taken else single
        most = min(last if taken.count(last) < counts[last] else last - 1, left)
        a = largest(most)
        while a >= 1 and many * a >= left - slack:
            if many == 1:
                yield (*taken, a)
                return
            yield from deeper((*taken, a), left - a, many - 1)
            a = largest(a - 1)

    if not few:
        yield from larger_fillings(counts, room, slack)
        return
    for many in (3, 4):
        yield from deeper((), room, many)


def pack(counts: dict[int, int], capacity: int, nodes: int = 3000) -> list[Pattern]:
    """Patterns that hold all lengths in few sequences; never more than best-fit decreasing takes.

    A first search of up to ``nodes`` nodes takes bins of at most five pieces, with each filling as often as it
    goes; it soon finds what such bins give. A second of up to ``nodes`` nodes takes bins of any number of pieces
    and fillings less often too. That one ends at a proven optimum unless it reaches ``nodes``."""
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    for few in (True, False):
        if sum(m for _, m in best) > bound:
            best = _search(counts, capacity, nodes, best, bound, few)
    return best


def _choices(left: dict[int, int], capacity: int, slack: int, few: bool) -> Iterator[tuple[tuple[int, ...], int]]:
    """Fillings beside the largest length, each with the number of times it is to be used less than it could be."""
    size = max(left)
    beside = dict(left)
    beside[size] -= 1
    beside = {s: n for s, n in beside.items() if n}
    for filling in fillings(beside, capacity - size, slack, few):
        yield filling, 0
    if few:
        return
    for filling in fillings(beside, capacity - size, slack):
        for less in range(1, _times(left, (size, *filling))):
            yield filling, less


def _used(pieces: tuple[int, ...]) -> dict[int, int]:
    used: dict[int, int] = {}
    for s in pieces:
        used[s] = used.get(s, 0) + 1
    return used


def _times(left: dict[int, int], pieces: tuple[int, ...]) -> int:
    return min(left[s] // n for s, n in _used(pieces).items())


def _search(counts: dict[int, int], capacity: int, nodes: int, best: list[Pattern], bound: int, few: bool) -> list[Pattern]:
    """The best of ``best`` and what branch and bound finds in ``nodes`` nodes."""
    fewest = sum(m for _, m in best)
    total = sum(s * n for s, n in counts.items())
    stack = [(counts, (), 0, 0, None)]  # lengths left, patterns so far (linked), bins, waste, choices not yet tried
    visited = 0
    while stack and fewest > bound and visited < nodes:
        left, made, bins, waste, options = stack.pop()
        visited += options is None
        allowed = (fewest - 1) * capacity - total
        if waste > allowed:
            continue
        if options is None:
            rest = best_fit(left, capacity)
            if bins + sum(m for _, m in rest) < fewest:
                fewest = bins + sum(m for _, m in rest)
                best = [*rest]
                link = made
                while link:
                    link, pattern = link
                    best.append(pattern)
                allowed = (fewest - 1) * capacity - total
            if not left or waste > allowed:
                continue
            options = _choices(left, capacity, allowed - waste, few)
        filling, less = next(options, (None, 0))
        if filling is None:
            continue
        stack.append((left, made, bins, waste, options))
        size = max(left)
        used = _used((size, *filling))
        spare = capacity - size - sum(filling)
        times = _times(left, (size, *filling)) - less
        if spare:
            most = max(1, (allowed - waste) // spare)
            if less and times >= most:  # the same as with more repeats
                visited += 1
                continue
            times = min(times, most)
        after = dict(left)
        for s, n in used.items():
            after[s] -= n * times
            if not after[s]:
                del after[s]
        stack.append((after, (made, (tuple(used.items()), times)), bins + times, waste + spare * times, None))
    return best


def places_of(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, rank_from, rank_to, times, sequence, offset)``: pieces of a length with ranks in a range lie
    ``times`` to a sequence, from this sequence and offset on."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, m in patterns:
        offset = 0
        for size, times in pattern:
            start = taken.get(size, 0)
            taken[size] = start + m * times
            rows.append((size, start, start + m * times, times, sequence, offset))
            offset += size * times
        sequence += m
    return rows


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, nodes: int = 3000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    A document is its token ids and ``end_id``; only one longer than ``capacity`` is cut. A null or empty
    text is the end id alone. Rows with null or repeated ids are packed like all others. Other columns are
    not read. An empty table gives an empty result. ``nodes`` bounds each of the two searches for fewer
    sequences than best-fit decreasing takes; all pieces are placed in any case.

    The driver gets the histogram of lengths, at most ``capacity`` rows. Ranks within a length are counted
    in buckets of about a million pieces at most, so one frequent length does not land in one task."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(cut_into_pieces(tokenizer, capacity, end_id), f"id {kind}, piece int, start long, length long, ids_crc32 long")
    pieces = written(made, "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    buckets = max(16, sum(histogram.values()) // 1_000_000)
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32"))
    ranked = spread.withColumn("inside", inside - 1).join(begins, ["length", "bucket"]).withColumn("rank", F.col("begin") + F.col("inside"))
    plan = spark.createDataFrame(
        places_of(pack(histogram, capacity, nodes)), "length long, rank_from long, rank_to long, times long, sequence long, at long")
    here = (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    k = F.col("rank") - F.col("rank_from")
    return ranked.join(plan, here).select(
        "id", "piece", "start", ranked["length"], "ids_crc32", (F.col("sequence") + F.floor(k / F.col("times"))).alias("sequence_id"),
        (F.col("at") + k % F.col("times") * ranked["length"]).alias("offset"))
