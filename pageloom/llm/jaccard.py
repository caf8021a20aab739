"""n-gram Jaccard join with signature trees.

A document is its set of distinct 5-word shingles. Documents with equal sets are one class. Classes that
can be linked share a shingle among the first quarter of their shingles, in one order for all (frequent
ones last), so the classes of one such shingle form a group.

Within a group a signature tree is built: its nodes hold the OR of their members' token bitmaps and the
range of their sizes. A dual traversal drops node pairs whose largest possible overlap is too small for the
wanted similarity. The pairs that are left join classes into clusters; a spanning forest of them is enough.

The texts of a cluster then meet once. Trees over wider bitmaps offer the likeliest pairs first, each is
compared exactly, and pairs that are joined already need no comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import hold_nothing, small_batches
from pageloom.llm.components import connected
from pageloom.llm.words import mix, places, slices, windows, word_hashes
from pageloom.session import written

SHINGLE = 5
#: Similarity from which documents are linked: intersection / union >= 3/4, so the intersection is at
#: least 3/7 of the summed sizes.
SIMILAR = (3, 4)
#: Members of a tree node; members in a block of a group or cluster; shingles in a block of a cluster. What is
#: larger is compared in pairs of blocks.
FANOUT = 8
MEMBERS = 1024
BLOCK = 1_000_000
#: Groups of up to so many members are known by the set of their members, so that equal ones merge.
NAMED = 64
#: Bytes of text whose shingles a task holds at a time; a run takes some twenty times as much.
RUN = 1 << 21
#: Bytes of bitmaps that are compared at a time; pairs that are read from a list at a time.
WIDE = 1 << 22
PIECE = 1 << 14


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, shingles, sizes)``: every text's distinct shingles, by row and then by hash.

    A text of one to four words is one shingle of all its words; a null or one without words has none."""
    hashes, counts = word_hashes(column, fold=True)
    rows, at = places(counts)
    grams = windows(hashes, SHINGLE)
    full = at[: len(grams)] + SHINGLE <= counts[rows[: len(grams)]]
    all_rows, all_grams = [rows[: len(grams)][full]], [grams[full]]
    begins = np.cumsum(counts) - counts
    for k in range(1, SHINGLE):
        short = np.flatnonzero(counts == k)
        all_rows.append(short)
        all_grams.append(windows(hashes, k, seed=k)[begins[short]] if len(short) else np.zeros(0, np.uint64))
    rows, grams = np.concatenate(all_rows), np.concatenate(all_grams)
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    rows, grams = rows[new], grams[new]
    return rows, grams, np.bincount(rows, minlength=len(column)).astype(np.int64)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Wrapping sums of consecutive stretches."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def bitmap_bits(sizes: np.ndarray) -> np.ndarray:
    """Bits of a token bitmap: the power of two from twice the set's size on, 64 at least."""
    return np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(1, 2 * sizes))).astype(np.int64))


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, text)`` to ``(id, n, set_a, set_b, bitmap)``: size, 128-bit name and token bitmap of the set."""
    hold_nothing()
    for batch in batches:
        for part in slices(batch, 1, RUN):
            rows, grams, sizes = shingle_sets(part.column(1))
            bits = bitmap_bits(sizes)
            packed = np.concatenate(bitmaps(rows, grams, sizes, bits))
            offsets = np.concatenate([[0], np.cumsum(bits) // 8]).astype(np.int32)
            column = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), _long(_sums(mix(grams), sizes)), _long(_sums(mix(grams ^ np.uint64(0x5BD1E995)), sizes)), column],
                ["id", "n", "set_a", "set_b", "bitmap"])


def local_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, text)`` to ``(shingle, seen)``: shingles that at least 8 documents and one in a thousand of
    the run of rows at hand hold."""
    hold_nothing()
    for batch in batches:
        for part in slices(batch, 1, 2 * RUN):
            _, grams, _ = shingle_sets(part.column(1))
            found, seen = np.unique(grams, return_counts=True)
            much = seen >= max(8, len(part) // 1000)
            yield pa.RecordBatch.from_arrays([_long(found[much]), pa.array(seen[much])], ["shingle", "seen"])


def frequent_shingles(texts: DataFrame, most: int = 200_000) -> np.ndarray:
    """Up to ``most`` shingles that many documents hold, to be put last. Any choice gives right results,
    since all documents use the same one; it keeps the groups of widely shared passages small. The bound
    proves its size: 8 bytes each."""
    seen = texts.mapInArrow(local_frequent, "shingle long, seen long").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    top = seen.orderBy(F.desc("seen"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(np.asarray(top.column(0).combine_chunks(), np.int64).view(np.uint64))


def first_shingles(frequent) -> object:
    """``(id, text)`` to ``(key, name)``: the set's name under each of its first quarter of shingles."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_nothing()
        last = frequent.value
        for batch in batches:
            for part in slices(batch, 1, 2 * RUN):
                rows, grams, sizes = shingle_sets(part.column(1))
                if not len(rows):
                    continue
                names = _sums(mix(grams), sizes)
                once = np.zeros(len(part), bool)  # copies within the run of rows at hand send their keys once
                once[np.unique(names, return_index=True)[1]] = True
                late = np.zeros(len(grams), bool)
                if len(last):
                    late = last[np.minimum(np.searchsorted(last, grams), len(last) - 1)] == grams
                order = np.lexsort((late, rows))  # stable: within each half the hashes stay in order
                begins = np.cumsum(sizes) - sizes
                rank = np.arange(len(rows)) - begins[rows]
                num, den = SIMILAR
                kept = rank < (sizes - (num * sizes + den - 1) // den + 1)[rows]
                kept &= once[rows]
                yield pa.RecordBatch.from_arrays([_long(grams[order][kept]), _long(names[rows[kept]])], ["key", "name"])

    return emit


def group_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and name to ``(grp, name)`` of every key that two names hold.

    A small group is called by a hash of its members, so that the many keys that the same classes share
    make one group. Of a large group, called by its key, rows are passed on as they come."""
    sent: set[int] = set()
    large = None  # key of a large group that goes on
    kept = np.zeros((0, 2), np.int64)

    def whole(data: np.ndarray) -> pa.RecordBatch:
        groups, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(data):
            begin = np.flatnonzero(np.concatenate([[True], data[1:, 0] != data[:-1, 0]]))
            size = np.diff(np.append(begin, len(data)))
            called = _sums(mix(data[:, 1].copy().view(np.uint64)), size).view(np.int64)
            for b, n, c in zip(begin.tolist(), size.tolist(), called.tolist()):
                goes_on = data[b, 0] == large
                if n == 1 and not goes_on:
                    continue
                if n > NAMED or goes_on:
                    c = data[b, 0]
                elif c in sent:
                    continue
                else:
                    if len(sent) > 1_000_000:
                        sent.clear()
                    sent.add(c)
                groups.append(np.full(n, c, np.int64))
                names.append(data[b : b + n, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(groups)), pa.array(np.concatenate(names))], ["grp", "name"])

    for batch in batches:
        data = np.concatenate([kept, np.stack([np.asarray(batch.column(i), np.int64) for i in (0, 1)], 1)])
        if not len(data):
            continue
        new = np.ones(len(data), bool)
        new[1:] = (data[1:] != data[:-1]).any(1)
        data = data[new]
        last = int(np.searchsorted(data[:, 0], data[-1, 0]))  # sorted by key, as Spark sorts signed longs
        yield whole(data[:last])
        kept = data[last:]
        if len(kept) > 16 * NAMED:  # a large group: pass it on
            large = kept[0, 0]
            yield whole(kept[:-1])
            kept = kept[-1:]
    yield whole(kept)


@dataclass
class Tree:
    """Levels of nodes, leaves first; each level has bitmaps, size ranges, excess and component."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def build(cls, bitmaps: np.ndarray, sizes: np.ndarray, parts: np.ndarray) -> Tree:
        """``bitmaps``: words of 64 bits, one row for each member; members are in order of size. Excess
        counts the tokens of a member that fell on a bit already set. Component -1: several."""
        excess = sizes - np.bitwise_count(bitmaps).sum(1, dtype=np.int64)
        levels = [(bitmaps, sizes, sizes, excess, parts)]
        while len(levels[-1][0]) > FANOUT:
            maps, low, high, extra, part = levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            same = np.minimum.reduceat(part, at) == np.maximum.reduceat(part, at)
            levels.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                           np.maximum.reduceat(extra, at), np.where(same, part[at], -1)))
        return cls(levels)


def _possible(x, y, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether any member of node i of level x can be linked with one of node j of level y."""
    (xm, xl, xh, xe, xp), (ym, yl, yh, ye, yp) = x, y
    num, den = SIMILAR
    ok = (den * xh[i] >= num * yl[j]) & (den * yh[j] >= num * xl[i]) & ~((xp[i] == yp[j]) & (xp[i] >= 0))
    step = max(1, WIDE // max(1, 8 * xm.shape[1]))
    for a in range(0, len(i), step):
        k = np.flatnonzero(ok[a : a + step]) + a
        common = np.bitwise_count(xm[i[k]] & ym[j[k]]).sum(1, dtype=np.int64)
        overlap = common + np.minimum(xe[i[k]], ye[j[k]])
        ok[k] = (num + den) * overlap >= num * (xl[i[k]] + yl[j[k]])
    return ok


def traverse(one: Tree, two: Tree | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Member pairs of a tree with itself, or of two trees, that no pair of nodes above them rules out."""
    other = two or one
    level, down = len(one.levels) - 1, len(other.levels) - 1
    i, j = np.meshgrid(*(np.arange(len(x[0]), dtype=np.int32) for x in (one.levels[level], other.levels[down])), indexing="ij")
    i, j = i.ravel(), j.ravel()
    while True:
        if two is None:
            i, j = i[i <= j], j[i <= j]
        ok = _possible(one.levels[level], other.levels[down], i, j)
        if two is None and not level:
            ok &= i != j  # above the members a node also meets itself
        i, j = i[ok], j[ok]
        if not level and not down:
            return i, j
        if level >= down:
            i, j = _children(i, j, len(one.levels[level - 1][0]))
            level -= 1
            if two is None:  # one tree: both sides go down together
                j, i = _children(j, i, len(other.levels[down - 1][0]))
                down -= 1
        else:
            j, i = _children(j, i, len(other.levels[down - 1][0]))
            down -= 1


def _children(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    below = (i[:, None] * FANOUT + np.arange(FANOUT, dtype=np.int32)).ravel()
    there = below < n
    return below[there], np.repeat(j, FANOUT)[there]


def _folded(bitmaps: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width: a hash modulo half the bits."""
    half = bitmaps.shape[1] // 2
    return bitmaps[:, :half] | bitmaps[:, half:]


def bitmaps(rows: np.ndarray, grams: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> list[np.ndarray]:
    """Each set's token bitmap as words of 64 bits."""
    ends = np.cumsum(bits)
    marks = np.zeros(int(bits.sum()), bool)
    marks[(ends - bits)[rows] + (grams & (bits - 1).astype(np.uint64)[rows]).astype(np.int64)] = True
    packed = np.packbits(marks, bitorder="little").view(np.uint64)
    return np.split(packed, (ends // 64)[:-1])


def tree_pairs(sizes: np.ndarray, maps: list[np.ndarray], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members that may be linked and are of different components.

    Linked sets differ in size by less than a factor of two, so their bitmaps have one width or the next:
    there is a tree for each width, and the wider of two is folded."""
    order = np.argsort(sizes, kind="stable").astype(np.int32)
    widths = np.array([len(maps[k]) for k in order])
    out: list[tuple[np.ndarray, np.ndarray]] = []
    trees = {}
    for width in np.unique(widths).tolist():
        mine = order[widths == width]
        own = np.stack([maps[k] for k in mine])
        trees[width] = mine, own, Tree.build(own, sizes[mine], parts[mine])
    for width, (mine, own, tree) in trees.items():
        i, j = traverse(tree)
        out.append((mine[i], mine[j]))
        if width % 2 == 0 and width // 2 in trees:
            less, _, smaller = trees[width // 2]
            i, j = traverse(smaller, Tree.build(_folded(own), sizes[mine], parts[mine]))
            out.append((less[i], mine[j]))
    return tuple(np.concatenate(x) for x in zip(*out))


def runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows in whole runs of equal first ``columns`` columns; a run is bounded by its maker."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        held = []
        keys = np.stack([np.asarray(table.column(i).combine_chunks(), np.int64) for i in range(columns)], 1)
        cut = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
        for a, b in zip(cut[:-2].tolist(), cut[1:-1].tolist()):
            yield table.slice(a, b - a).combine_chunks().to_batches()[0]
        held = table.slice(int(cut[-2])).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Forest:
    """Components by number, joined as links are found."""

    def __init__(self, parts: np.ndarray):
        _, self.parts = np.unique(parts, return_inverse=True)
        self.parent = list(range(int(self.parts.max(initial=-1)) + 1))

    def joins(self, a: int, b: int) -> tuple[int, int] | None:
        """The two components, if the members are not joined yet."""
        p, q = self._top(int(self.parts[a])), self._top(int(self.parts[b]))
        return (p, q) if p != q else None

    def join(self, p: int, q: int) -> None:
        self.parent[p] = q

    def apart(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
        """The pairs in their order, without those whose members are joined when their piece of the list begins."""
        for a in range(0, len(i), PIECE):
            some, others = i[a : a + PIECE], j[a : a + PIECE]
            top = np.array(self.parent, np.int64)
            while not np.array_equal(top, above := top[top]):
                top = above
            top = top[self.parts]
            far = top[some] != top[others]
            yield from zip(some[far].tolist(), others[far].tolist())

    def _top(self, p: int) -> int:
        parent = self.parent
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p


def _pairs_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[c] for k in links], pa.int64()) for c in (0, 1)], ["x", "y"])


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def search_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(grp, one, two, block, rep, n, bitmap)`` of pairs of blocks to pairs ``(x, y)`` that may be
    linked: a spanning forest of all such pairs."""
    hold_nothing()
    links: list[tuple[int, int]] = []
    for run in runs(batches, 3):
        apart = run.column(1)[0] != run.column(2)[0]
        block, reps, sizes = (np.asarray(run.column(i), np.int64) for i in (3, 4, 5))
        i, j = tree_pairs(sizes, _unpacked(run.column(6)), np.arange(len(reps)))
        if apart:  # pairs within one block belong to that block's own run
            i, j = i[block[i] != block[j]], j[block[i] != block[j]]
        forest = Forest(np.arange(len(reps)))
        for a, b in forest.apart(i, j):
            if tops := forest.joins(a, b):
                forest.join(*tops)
                links.append((min(reps[a], reps[b]), max(reps[a], reps[b])))
        if len(links) > 10_000:
            yield _pairs_batch(list(set(links)))
            links = []
    yield _pairs_batch(list(set(links)))


def search_clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(cluster, one, two, block, rep, part, text)`` of pairs of blocks to links ``(x, y)``.

    What the trees leave is compared exactly, the likeliest pairs first. A link joins two components, and
    pairs within one component need no comparison, so the links found are those of a spanning forest."""
    hold_nothing()
    num, den = SIMILAR
    for run in runs(batches, 3):
        apart = run.column(1)[0] != run.column(2)[0]
        block, reps, parts = (np.asarray(run.column(i), np.int64) for i in (3, 4, 5))
        forest = Forest(parts)
        rows, grams, sizes = shingle_sets(run.column(6))
        sets = np.split(grams, np.cumsum(sizes)[:-1])
        maps = bitmaps(rows, grams, sizes, 4 * bitmap_bits(sizes))
        i, j = tree_pairs(sizes, maps, forest.parts)
        if apart:
            i, j = i[block[i] != block[j]], j[block[i] != block[j]]
        likely = np.argsort(-_likeness(maps, sizes, i, j), kind="stable")
        links = []
        for a, b in forest.apart(i[likely], j[likely]):
            if tops := forest.joins(a, b):
                both = shared(sets[a], sets[b])
                if den * both >= num * (sizes[a] + sizes[b] - both) and both:
                    forest.join(*tops)
                    links.append((reps[a], reps[b]))
        if links:
            yield _pairs_batch(links)


def _likeness(maps: list[np.ndarray], sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common bits against summed sizes, to order pairs by."""
    out = np.zeros(len(i))
    widths = np.array([len(m) for m in maps])
    place = np.zeros(len(maps), np.int64)
    of = {}
    for width in np.unique(widths).tolist():
        mine = np.flatnonzero(widths == width)
        place[mine] = np.arange(len(mine))
        of[width] = np.stack([maps[k] for k in mine])
    for one, two in ((x, y) for x in of for y in of):
        both = np.flatnonzero((widths[i] == one) & (widths[j] == two))
        n = min(one, two)
        for a in range(0, len(both), step := max(1, WIDE // (8 * n))):
            k = both[a : a + step]
            common = np.bitwise_count(of[one][place[i[k]], :n] & of[two][place[j[k]], :n]).sum(1, dtype=np.int64)
            out[k] = common / (sizes[i[k]] + sizes[j[k]]) * (one / n)
    return out


def block_pairs(rows: DataFrame, key: str, blocks: F.Column) -> DataFrame:
    """Rows in blocks by a hash of their representative, once for every pair ``(one, two)`` of blocks of
    their key that theirs is in."""
    told = rows.withColumn("blocks", blocks).withColumn("block", F.expr("pmod(xxhash64(rep), blocks)").cast("long"))
    other = told.withColumn("other", F.explode(F.expr("sequence(0L, cast(blocks - 1 as bigint))")))
    return other.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("other", "blocks")


def cluster_links(clusters: DataFrame, texts: DataFrame) -> DataFrame:
    """Links within clusters ``(cluster, rep, n, part)``.

    Clusters of one block are compared whole. For the others every block is compared in itself and with the
    cluster's first member, which joins most of a large group of near copies; then all pairs of blocks of
    the clusters that are still of several components."""
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.greatest(F.sum("n") / BLOCK, F.count(F.lit(1)) / MEMBERS)).cast("long").alias("blocks"), F.min_by("rep", "rep").alias("first"))
    told = written(clusters.join(sizes, "cluster").withColumn("block", F.expr("pmod(xxhash64(rep), blocks)")), "clusters")
    bridges = told.where("blocks > 1 and rep = first").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    own = told.where("blocks = 1 or rep <> first").union(bridges.select(told.columns))
    ready = texts.withColumnRenamed("id", "rep").join(own.hint("shuffle_hash"), "rep").select(
        "cluster", F.col("block").alias("one"), F.col("block").alias("two"), "block", "rep", "part", "text")
    runs_of = ready.repartition("cluster", "one", "two").sortWithinPartitions("cluster", "one", "two")
    links = written(runs_of.mapInArrow(search_clusters, "x long, y long"), "links")
    several = told.where("blocks > 1")
    if several.isEmpty():
        return links
    joined = connected(links).withColumnRenamed("node", "rep").withColumnRenamed("component", "now")
    open_ = several.join(joined, "rep", "left").withColumn("part", F.coalesce("now", "part")).drop("now")
    still = open_.groupBy("cluster").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("cluster")
    rest = written(open_.join(still, "cluster", "left_semi").select("cluster", "rep", "part", "blocks"), "open")
    if rest.isEmpty():
        return links
    met = block_pairs(rest, "cluster", F.col("blocks")).where("one < two")
    found = texts.withColumnRenamed("id", "rep").join(met.hint("shuffle_hash"), "rep").select("cluster", "one", "two", "block", "rep", "part", "text")
    found = found.repartition("cluster", "one", "two").sortWithinPartitions("cluster", "one", "two")
    return links.union(found.mapInArrow(search_clusters, "x long, y long"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component)``, one row per row of ``docs`` with an id.

    Two documents are linked when 100 * intersection >= 75 * union of their sets of distinct 5-word
    shingles (A-Z lower-cased); the component is the smallest id that links reach. A document without
    words, or null, has an empty set and is linked with nothing.

    Ids are integers; rows with a null id get a null component. Rows that share an id are one node: its
    links are those of all its texts, and each row keeps its own set size. Other columns are not read. An
    empty table gives an empty result.

    Equal sets meet by name first, so copies cost one row each, and the texts of a cluster are moved once.
    Groups are sorted and read as streams. Groups and clusters beyond a block are compared in pairs of
    blocks, never as a whole."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = written(rows.mapInArrow(describe, "id long, n long, set_a long, set_b long, bitmap binary"), "sets")
    texts = rows.where("id is not null and text is not null")
    full = sets.where("n > 0 and id is not null")
    classes = written(full.groupBy("set_a", "set_b").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.min_by("bitmap", "id").alias("bitmap")
    ).withColumnRenamed("set_a", "name"), "classes")
    copies = full.join(classes.select(F.col("name").alias("set_a"), "set_b", "rep"), ["set_a", "set_b"]).select("id", "rep").where("id <> rep")

    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(texts))
    keys = texts.mapInArrow(first_shingles(frequent), "key long, name long")
    members = keys.repartition("key").sortWithinPartitions("key", "name").mapInArrow(group_members, "grp long, name long")
    groups = written(members.distinct(), "groups")

    # sizes alone leave out members without a partner of a size within 3 to 4; bitmaps are attached last
    sized = groups.join(classes.select("name", "rep", "n").hint("merge"), "name")
    # counted by size first, so that a group in one task has a row for each of its sizes, not for each class
    order = Window.partitionBy("grp").orderBy("n")
    num, den = SIMILAR
    steps = sized.groupBy("grp", "n").agg(F.count(F.lit(1)).alias("classes"))
    near = (den * F.lag("n").over(order) >= num * F.col("n")) | (den * F.col("n") >= num * F.lead("n").over(order))
    kept = written(steps.withColumn("near", F.coalesce(near, F.lit(False))).where("classes > 1 or near").drop("near"), "steps")
    placed = sized.join(kept.select("grp", "n"), ["grp", "n"], "left_semi")
    sizes = kept.groupBy("grp").agg(F.ceil(F.sum("classes") / MEMBERS).cast("long").alias("blocks")).where("blocks > 1")
    pairs = block_pairs(placed.join(sizes, "grp", "left"), "grp", F.coalesce("blocks", F.lit(1)))
    met = pairs.join(classes.select("name", "bitmap").hint("merge"), "name").select("grp", "one", "two", "block", "rep", "n", "bitmap")
    met = met.repartition("grp", "one", "two").sortWithinPartitions("grp", "one", "two")
    able = written(connected(met.mapInArrow(search_groups, "x long, y long")), "able")
    clusters = able.join(classes.withColumnRenamed("rep", "node"), "node").select(
        F.col("component").alias("cluster"), F.col("node").alias("rep"), "n", F.col("node").alias("part"))
    links = cluster_links(clusters, texts)

    final = connected(links.select("x", "y").union(copies.select("rep", "id")))
    return sets.select("id", "n").join(final.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
