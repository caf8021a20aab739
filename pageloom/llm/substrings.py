"""Substring dedup by difference-cover anchors.

A window is 20 consecutive words. Hashing every window would shuffle every word of the corpus, so windows
are found in two steps. (1) Only 8-word anchors at places p with p modulo 13 in {0, 1, 3, 9} are hashed:
these residues have every difference modulo 13, so for any two places i and j there is a shift below 13
that takes both to such residues. As 8 + 13 - 1 <= 20, two equal windows share an anchor at one common
shift. (2) Anchors that occur twice are extended: the windows around them are compared whole, by 96 bits,
and each window that also starts earlier is removed. 48 bits of an anchor are shuffled: a clash there
only adds windows to compare.

Documents whose whole text occurs in a document with a smaller id need neither step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.common import hold_nothing, small_batches
from pageloom.llm.words import mix, places, slices, windows, word_hashes

WINDOW = 20
PERIOD = 13
#: A difference cover of the period: every residue is a difference of two of these.
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Parts that the copies of one text meet in.
PARTS = 16


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _spread_key(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A key that nothing else shares, for rows whose verdict is known before the shuffle."""
    return mix(mix(doc.astype(np.int64).view(np.uint64)) + place.astype(np.uint64))


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, text)`` to ``(key, id, place)``; the lowest bit of ``place`` tells that the anchor is known.

    An anchor that repeats within the run of rows at hand is known to repeat: one row of it is sent to
    find its equals elsewhere, the others are spread by a key of their own. So a passage that a third of
    all documents hold sends one row for each run to the task of its hash."""
    hold_nothing()
    for batch in batches:
        for part in slices(batch, 1):
            hashes, counts = word_hashes(part.column(1))
            keys = windows(hashes, ANCHOR)
            if not len(keys):
                continue
            rows, at = (x[: len(keys)] for x in places(counts))
            fits = (at + ANCHOR <= counts[rows]) & (counts[rows] >= WINDOW) & np.isin(at % PERIOD, COVER)
            keys, rows, at = keys[fits], rows[fits], at[fits]
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            again = np.zeros(len(order), bool)
            again[1:] = ordered[1:] == ordered[:-1]
            twice = again.copy()
            twice[:-1] |= again[1:]
            known = np.zeros(len(keys), bool)
            known[order] = twice
            repeat = np.zeros(len(keys), bool)
            repeat[order] = again
            ids = np.asarray(part.column(0).cast(pa.int64()))[rows]
            keys[repeat] = _spread_key(ids[repeat], at[repeat])
            yield pa.RecordBatch.from_arrays(
                [_long(keys >> np.uint64(16)), pa.array(ids), pa.array((at << 1 | known).astype(np.int32))], ["key", "id", "place"])


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key occurs twice or that are known to repeat: ``(id, place)``.

    A run of equal keys may span batches; the last row of a batch waits for the next one."""
    held = np.zeros((0, 3), np.int64)
    linked = False

    def keep(rows: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
        rows = rows[mask | (rows[:, 2] & 1 > 0)]
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 1]), pa.array((rows[:, 2] >> 1).astype(np.int32))], ["id", "place"])

    for batch in batches:
        rows = np.concatenate([held, np.stack([np.asarray(batch.column(i), np.int64) for i in range(3)], 1)])
        if not len(rows):
            continue
        same = rows[1:, 0] == rows[:-1, 0]
        mask = np.zeros(len(rows), bool)
        mask[1:] |= same
        mask[:-1] |= same
        mask[0] |= linked
        yield keep(rows[:-1], mask[:-1])
        linked = bool(mask[-1])
        held = rows[-1:]
    yield keep(held, np.full(len(held), linked))


def find_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, text, anchor places)`` to ``(low, high, id, place)``: the windows that hold an anchor, by 64
    and 32 bits; the lowest bit of ``place`` tells that the window is known to be removed.

    Of equal windows within the run of rows at hand only the earliest is sent to meet its equals
    elsewhere; the others are known to be removed and are spread."""
    hold_nothing()
    for batch in batches:
        for part in slices(batch, 1):
            hashes, counts = word_hashes(part.column(1))
            low = windows(hashes, WINDOW)
            if not len(low):
                continue
            begins = np.cumsum(counts) - counts
            lists = part.column(2)
            lengths = np.asarray(pa.compute.list_value_length(lists), np.int64)
            rows = np.repeat(np.arange(len(part)), lengths)
            anchors = np.asarray(lists.flatten(), np.int64)
            inside = anchors + ANCHOR <= counts[rows]  # rows that share an id may differ in length
            rows, anchors = rows[inside], anchors[inside]
            first = np.maximum(anchors - PERIOD + 1, 0)
            after = np.minimum(anchors, counts[rows] - WINDOW) + 1
            good = first < after
            edges = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(edges, begins[rows[good]] + first[good], 1)
            np.add.at(edges, begins[rows[good]] + after[good], -1)
            at = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
            if not len(at):
                continue
            row_of, place = places(counts)
            ids = np.asarray(part.column(0).cast(pa.int64()))[row_of[at]]
            start = place[at]
            low, high = low[at], windows(hashes, WINDOW, seed=1)[at] >> np.uint64(32)
            order = np.lexsort((start, ids, high, low))
            equal = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
            later = np.zeros(len(order), bool)  # a repeated row is no earlier place than itself
            later[1:] = equal & ((ids[order][1:] != ids[order][:-1]) | (start[order][1:] != start[order][:-1]))
            known = np.zeros(len(at), bool)
            known[order] = _run_any(later, np.concatenate([[False], equal]))
            # a known row needs no equals: it carries the bits that mark it in place of the second hash
            high[known] = low[known] >> np.uint64(32)
            low[known] = _spread_key(ids[known], start[known])
            yield pa.RecordBatch.from_arrays(
                [_long(low), pa.array(high.astype(np.uint32).view(np.int32)), pa.array(ids), pa.array((start << 1 | known).astype(np.int32))],
                ["low", "high", "id", "place"])


def _run_any(later: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Within runs of equal windows, true from the first later place on."""
    total = np.cumsum(later)
    begin = np.flatnonzero(~joined)
    base = np.repeat(total[begin] - later[begin], np.diff(np.append(begin, len(later))))
    return total > base


def later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by window, id and place, those that an earlier place precedes: ``(id, mark)``.

    ``mark`` holds the start and 32 bits of the window, so that rows which share an id are told apart."""
    last: tuple[int, int, int, int, bool] | None = None
    for batch in batches:
        if not len(batch):
            continue
        low, high, ids, place = (np.asarray(batch.column(i)) for i in range(4))
        start, known = place >> 1, (place & 1).astype(bool)
        equal = np.zeros(len(low), bool)
        equal[1:] = (low[1:] == low[:-1]) & (high[1:] == high[:-1])
        moved = np.ones(len(low), bool)
        moved[1:] = (ids[1:] != ids[:-1]) | (start[1:] != start[:-1])
        carried = False
        if last is not None and (low[0], high[0]) == last[:2]:
            equal[0] = True
            carried = last[4]
            moved[0] = (ids[0], start[0]) != last[2:4]
        later = equal & moved
        begun = equal.copy()
        begun[0] = False
        removed = _run_any(later, begun)
        if carried:  # the run goes on from the batch before, where a later place was seen already
            removed[: len(begun) if equal.all() else int(np.argmin(equal))] = True
        last = (low[-1], high[-1], ids[-1], start[-1], bool(removed[-1]))
        take = removed | known
        check = np.where(known, high.view(np.uint32), (low.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
        mark = start[take].astype(np.int64) << 32 | check[take].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids[take]), pa.array(mark)], ["id", "mark"])


def covered(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of n words the windows at these starts cover."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, text, copy, marks, row)`` to ``(id, text, n_words, n_removed, kept, row)``."""
    hold_nothing()
    for batch in batches:
        for part in slices(batch, 1):
            hashes, counts = word_hashes(part.column(1))
            check = (windows(hashes, WINDOW) >> np.uint64(32)).astype(np.int64)
            begins = np.cumsum(counts) - counts
            removed, kept = np.zeros(len(part), np.int64), []
            texts, copies = part.column(1).to_pylist(), part.column(2).to_pylist()
            for i, (text, copy, marks) in enumerate(zip(texts, copies, part.column(3))):
                n = int(counts[i])
                if copy and n >= WINDOW:
                    removed[i] = n
                    kept.append("")
                    continue
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                if marks.is_valid and n >= WINDOW:
                    marks = np.asarray(marks.values, np.int64)
                    start = marks >> 32
                    mine = start + WINDOW <= n
                    start, bits = start[mine], (marks & 0xFFFFFFFF)[mine]
                    start = start[check[begins[i] + start] == bits]
                    gone = covered(n, start)
                    removed[i] = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(counts), pa.array(removed), pa.array(kept, pa.string()), part.column(4)],
                ["id", "text", "n_words", "n_removed", "kept", "row"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, text, n_words, n_removed, kept, row)``: every row of ``docs`` without the words of repeated windows;
    ``row`` holds the columns to ``carry`` along, and there is none without such columns.

    A word goes when a window of 20 words covers it whose words also start earlier: in a document with a
    smaller id, or in the same document at an earlier start. Windows are judged on the input. ``kept`` is
    the kept words joined by one blank.

    A null text has no words. Texts of fewer than 20 words stay whole. Rows with a null id keep all their
    words and make no other place later. Rows that share an id are one document: equal places of it are
    not earlier than each other, so an exactly repeated row keeps what the first one keeps. Other columns
    of ``docs`` are not read. An empty table gives an empty result. Ids are integers. Texts and windows count as
    equal by hashes of 128 and 96 bits.

    Shuffles: the texts once, by id (the three passes over them share it); one row of about 20 bytes for
    each anchor; one row for each window around a repeated anchor. Both row streams are sorted and read
    as streams, so no group of equals is held in memory."""
    small_batches(docs.sparkSession)
    other = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), other.alias("row"))
    # the three passes start from the same rows, carried columns too, so that Spark shuffles the texts once
    full = rows.where("id is not null and text is not null")
    # the many copies of one text meet its smallest id in parts
    prints = full.select("id", F.md5("text").alias("print"), F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part"))
    firsts = prints.groupBy("print").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    copies = prints.join(firsts, ["print", "part"]).where("id > first").groupBy("id").agg(F.collect_set("print").alias("copies"))
    known = F.coalesce(F.array_contains("copies", F.md5("text")), F.lit(False))
    told = full.join(copies.hint("shuffle_hash"), "id", "left")
    fresh = told.where(~known).select("id", "text", "row")

    anchors = fresh.mapInArrow(find_anchors, "key long, id long, place int")
    again = anchors.repartition("key").sortWithinPartitions("key").mapInArrow(repeated, "id long, place int")
    spots = again.groupBy("id").agg(F.collect_list("place").alias("spots"))

    seen = fresh.join(spots.hint("shuffle_hash"), "id").select("id", "text", "spots", "row")
    found = seen.mapInArrow(find_windows, "low long, high int, id long, place int")
    later = found.repartition("low").sortWithinPartitions("low", "high", "id", "place").mapInArrow(later_windows, "id long, mark long")
    marks = later.groupBy("id").agg(F.collect_list("mark").alias("marks"))

    judged = told.withColumn("copy", known).join(marks.hint("shuffle_hash"), "id", "left").select("id", "text", "copy", "marks", "row")
    others = rows.where("id is null or text is null").select(
        "id", "text", F.lit(False).alias("copy"), F.lit(None).cast("array<long>").alias("marks"), "row")
    result = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "n_words", "n_removed")] + [T.StructField(c, T.StringType()) for c in ("text", "kept")] + [
        rows.schema["row"]])
    result = T.StructType([result[c] for c in ("id", "text", "n_words", "n_removed", "kept", "row")])
    made = judged.mapInArrow(cut, result).union(others.mapInArrow(cut, result))
    return made if carry else made.drop("row")


def brute_force(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, int, str]]:
    """The same by comparing all windows, for tests."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first: dict[tuple, tuple[int, int]] = {}
    for i, w in words:
        for s in range(len(w) - WINDOW + 1 if i is not None else 0):
            key = tuple(w[s : s + WINDOW])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in words:
        gone = [s for s in range(len(w) - WINDOW + 1 if i is not None else 0) if first[tuple(w[s : s + WINDOW])] < (i, s)]
        kept = [x for x, g in zip(w, covered(len(w), np.array(gone, np.int64))) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out
