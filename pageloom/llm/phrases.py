"""Phrase collocations by prefix-free parsing.

Every text becomes tokens: words, and a mark where a piece ends. Where the hash of ``longest - 1``
consecutive tokens is divisible by a period, a chunk ends with these tokens and the next one begins with them.
Equal passages fall into equal chunks, so copies collapse into one dictionary entry with a parse frequency.
Phrases are counted inside the distinct chunks, weighted by that frequency. A phrase of up to ``longest`` words
lies whole in the chunk that owns its first token, and only there: the tokens that a chunk shares with the
next one belong to the next one.

Words and pairs are counted first, pairs by hash. Longer phrases are looked at only where each of their pairs
occurs often enough, which a bitmap of fixed size tells; it may let rare pairs pass and never stops a frequent
one. The counts that decide are made by the phrases' own texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.bits import bitmap as filled_bits
from pageloom.llm.words import mix, slices, span_hashes, text_bytes, windows, word_hashes
from pageloom.session import written

#: A chunk holds so many tokens on the average.
PERIOD = 64
#: Bits of the bitmap of frequent pairs: 16 MB, whatever the size of the corpus.
BITS = 1 << 27
#: Bytes of text worked on at a time.
RUN = 1 << 21
#: The token that ends a piece; no word holds it.
MARK = "."
_SPACE, _END, _WORD = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 0x20
_FOLDED[_KIND == _END] = ord(MARK)


def ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings at the given places of a run of UTF-8 bytes."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    taken = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(taken)).cast(pa.string())


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, begins, counts)``: the tokens of all texts, each followed by a blank, their first bytes, and
    the number of tokens of each text. A-Z become a-z."""
    data, offsets = text_bytes(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(len(column), np.int64)
    kind = _KIND[data]
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(kind[1:], kind[:-1], out=fresh[1:])
    fresh[offsets[:-1][offsets[:-1] < n]] = True
    fresh |= kind == _END
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], n)
    keep = kind[first] != _SPACE
    first, last = first[keep], last[keep]
    begins = np.zeros(len(first) + 1, np.int64)
    np.cumsum(last - first + 1, out=begins[1:])
    out = np.full(begins[-1], 0x20, np.uint8)
    out[np.repeat(begins[:-1] - first, last - first) + _flat(first, last)] = _FOLDED[data[_flat(first, last)]]
    return out, begins, np.diff(np.searchsorted(first, offsets))


def _flat(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def parse(column: pa.Array, longest: int, period: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(chunks, rows, shared)``: the chunks of all texts, each chunk's text, and how many tokens at its end
    belong to the next chunk (none for the last chunk of a text)."""
    data, begins, counts = tokens(column)
    total = len(begins) - 1
    if not total:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    over = longest - 1
    last_of = np.repeat(np.cumsum(counts), counts)
    new = np.zeros(total, bool)
    new[(np.cumsum(counts) - counts)[counts > 0]] = True
    hashes = span_hashes(data, begins[:-1], begins[1:] - 1)
    found = windows(hashes, over) if over else hashes
    at = np.flatnonzero(found % np.uint64(period) == 0)
    new[at[at + over <= last_of[at]]] = True
    starts = np.flatnonzero(new)
    nexts = np.append(starts[1:], total)
    shared = np.where(nexts < last_of[starts], over, 0)
    chunks = ranges(data, begins[starts], begins[nexts + shared] - 1)
    return chunks, np.searchsorted(np.cumsum(counts), starts, "right"), shared


def dictionary(docs: DataFrame, longest: int, period: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, chunk, shared, times)``: every distinct chunk of a language and its parse frequency."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, RUN):
                chunks, rows, shared = parse(part.column(1), longest, period)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), chunks, pa.array(shared, pa.int32())], ["lang", "chunk", "shared"])

    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text <> ''")
    return texts.mapInArrow(cut, "lang string, chunk string, shared int").groupBy("lang", "chunk", "shared").agg(F.count(F.lit(1)).alias("times"))


class _Starts:
    """The tokens of a batch of dictionary rows, and where phrases of each length may start."""

    def __init__(self, batch: pa.RecordBatch):
        self.hashes, counts = word_hashes(batch.column(1))
        ends = np.cumsum(counts)
        self.rows = np.repeat(np.arange(len(counts)), counts)
        shared = np.asarray(batch.column(2), np.int64)
        place = np.arange(len(self.hashes))
        self.left = np.repeat(ends, counts) - place
        self.own = self.left > shared[self.rows]
        self.word = self.hashes != _MARK_HASH
        self.times = np.asarray(batch.column(3), np.int64)
        names = batch.column(0).dictionary_encode()
        self.seed = np.array([_number(x) for x in names.dictionary.to_pylist()], np.uint64)[np.asarray(names.indices)][self.rows]

    def inside(self, size: int) -> np.ndarray:
        """Where ``size`` tokens from here are words of one chunk."""
        n = len(self.word) - size + 1
        if n <= 0:
            return np.zeros(0, bool)
        fine = self.left[:n] >= size
        for i in range(size):
            fine &= self.word[i : i + n]
        return fine

    def keys(self, size: int) -> np.ndarray:
        """A hash of language and phrase for every start."""
        found = windows(self.hashes, size)
        return mix(found ^ self.seed[: len(found)])


def _number(name: str) -> int:
    return int.from_bytes(blake2b(name.encode("utf-8"), digest_size=8).digest(), "little")


_MARK_HASH = word_hashes(pa.array([MARK]))[0][0]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their weights, and one place of each."""
    order = np.argsort(keys, kind="stable")
    if not len(order):
        return keys, weights, order
    found = keys[order]
    begin = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    return found[begin], np.add.reduceat(weights[order], begin), order[begin]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dictionary rows to ``(key, times)`` of their pairs of words."""
    for batch in batches:
        for part in slices(batch, 1, RUN):
            s = _Starts(part)
            at = np.flatnonzero(s.inside(2) & s.own[:-1])
            keys, times, _ = _summed(s.keys(2)[at], s.times[s.rows[at]])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], ["key", "times"])


def _bits(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return keys & np.uint64(bits - 1), (keys >> np.uint64(32)) & np.uint64(bits - 1)


def bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """Two bits set for each ``key``; the executors fill them, so only the bitmap comes to the driver."""
    place = F.explode(F.array(F.col("key").bitwiseAND(bits - 1), F.shiftrightunsigned("key", 32).bitwiseAND(bits - 1)))
    return filled_bits(frequent.select(place.alias("at")), bits).view(np.uint32)


def _has(filled: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for place in _bits(keys, bits):
        out &= (filled[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0
    return out


def _phrases(filled, longest: int, bits: int):
    """Dictionary rows to ``(lang, phrase, words, times)``: all words, and phrases whose pairs the bitmap knows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "words", "times"]
        for batch in batches:
            for part in slices(batch, 1, RUN):
                s = _Starts(part)
                data, offsets = text_bytes(part.column(1))
                blank = data == 0x20
                # tokens are parted by one blank or by the end of a chunk
                edge = np.zeros(len(data) + 1, bool)
                edge[1:][blank] = True
                edge[offsets[:-1]] = True
                first = np.flatnonzero(edge[:-1])
                last = np.append(first[1:], len(data) + 1) - 1
                ends = offsets[1:][s.rows]
                last = np.where(s.left == 1, ends, last)
                known = np.append(_has(filled.value, s.keys(2), bits), False) if len(s.word) > 1 else np.zeros(len(s.word), bool)
                for size in range(1, longest + 1):
                    fine = s.inside(size)
                    if not len(fine):
                        continue
                    fine &= s.own[: len(fine)]
                    for i in range(size - 1):
                        fine &= known[i : i + len(fine)]
                    at = np.flatnonzero(fine)
                    _, times, one = _summed(s.keys(size)[at], s.times[s.rows[at]])
                    some = at[one]
                    for a in range(0, len(some), 200_000):
                        b = some[a : a + 200_000]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(s.rows[b])), ranges(data, first[b], last[b + size - 1]),
                             pa.array(np.full(len(b), size), pa.int32()), pa.array(times[a : a + 200_000])], names)

    return count


def phrase_counts(
    docs: DataFrame, least: int = 30, longest: int = 4, period: int = PERIOD, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, f)`` of all phrases of 1 to ``longest`` words that occur ``least`` times or more in
    their language, and ``(lang, n)``, the number of words of each language.

    A text falls into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs; A-Z count as a-z.
    All occurrences within pieces count, overlapping ones too. A null text is empty and a null language ``und``.
    Repeated rows count each time. A text of any length is read whole; only its distinct chunks stay. An empty
    table gives empty tables. Other columns are not read.

    Counts are sums of the phrases' own texts over tasks. Within one batch of a task equal 64-bit hashes
    stand for equal phrases. The bitmap of frequent pairs is the only thing sent to all tasks; its size is fixed."""
    spark = docs.sparkSession
    chunks = written(dictionary(docs, longest, period, text_col, lang_col), "chunks")
    frequent = chunks.mapInArrow(_pairs, "key long, times long").groupBy("key").agg(F.sum("times").alias("times")).where(F.col("times") >= least)
    filled = spark.sparkContext.broadcast(bitmap(frequent, BITS))
    made = chunks.mapInArrow(_phrases(filled, longest, BITS), "lang string, phrase string, words int, times long")
    counted = written(
        made.groupBy("lang", "words", "phrase").agg(F.sum("times").alias("f")).where((F.col("f") >= least) | (F.col("words") == 1)), "phrases")
    sizes = counted.where("words = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    return counted.where(F.col("f") >= least).select("lang", "phrase", "words", "f"), sizes


def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, share: int = 80, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language.

    ``a`` is a phrase's count. Cut after its first k words it has parts with counts ``l`` and ``r`` and the score
    floor(2,000,000 a / (l + r)); the lowest-scoring cut counts, of equal ones the first. A phrase goes if some
    longer one that holds it has at least ``share`` percent of its count. Ranks go by score and count from above,
    then by phrase. Arithmetic is on decimals, so products may pass 64 bits. See :func:`phrase_counts` for the
    treatment of odd rows. A language without phrases has no rows."""
    counted, sizes = phrase_counts(docs, least, longest, text_col=text_col, lang_col=lang_col)
    part = counted.select("lang", "phrase", "f")
    many = counted.where("words >= 2").withColumn("w", F.split("phrase", " "))
    cuts = many.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"), F.array_join(F.expr("slice(w, k + 1, size(w))"), " ").alias("rest"))
    heads = part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) AS DECIMAL(38,0)) div CAST(CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)) AS DECIMAL(38,0))")
    cut = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", score)
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    spans = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), s -> array_join(slice(w, s, n), ' '))))")
    inner = many.where("words >= 3").select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact("longer") * F.lit(100) < _exact("a") * F.lit(share)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.select("lang", "phrase", "a", "best.*").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
