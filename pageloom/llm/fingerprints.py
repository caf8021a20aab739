"""Document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs, long ones in stretches that end with a sentence, are hashed; each digest is added to one
cell in each third of a sketch. A cell holds the number of its digests, their exclusive or, and the exclusive or
of their check values. Subtracting the sketches of two versions leaves the digests in which they differ:
a cell with a single one shows it by its check value, is taken out of its three cells, and so uncovers others.
When cells are left over, the pair is tried again with a larger sketch.

All of it is DataFrame operations. Cells are rows, grouped by their pair of texts, so that a sketch of any size is
peeled without ever being held in one value; one shuffle brings the digests of a pair together, and the turns
of peeling follow in the same stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import written

#: Cells of a fingerprint, a third of them for each hash function.
CELLS = 24
#: A paragraph of more characters than this goes on to its next sentence end only.
STRETCH = 120
#: Thirds looked at in turn before leftover cells count as a failure.
TURNS = 9
#: Larger sketches tried before the digests themselves are compared.
TRIES = 6


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text without outer blanks: lines, long ones cut at sentence ends."""
    found = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{STRETCH}}}[^\n.!?]*[.!?]*"), F.lit(0))
    return F.filter(F.transform(found, lambda p: F.trim(p)), lambda p: p != "")


def digests(text: Column) -> Column:
    """The distinct 64-bit hashes of a text's paragraphs; a text of blanks has none."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def cells_of(sides: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, size, seed, cell, n, k, h)``: the sketch cells of every row of ``(*keys, size, seed, digests)``."""
    items = sides.select(*keys, "size", "seed", F.explode("digests").alias("k"))
    spread = items.select(*keys, "size", "seed", "k", _check("k").alias("h"), F.explode(_places("k")).alias("cell"))
    return spread.groupBy(*keys, "size", "seed", "cell").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(k)").alias("k"), F.expr("bit_xor(h)").alias("h"))


def _check(key: str) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(0xFFFFFFFF)


def _places(key: str) -> Column:
    """The three cells of a key, one in each third."""
    third = F.expr("size div 3")
    return F.array(*[F.pmod(F.xxhash64(key, "seed", F.lit(j)), third) + third * j for j in range(3)])


def subtract(cells: DataFrame, *keys: str) -> DataFrame:
    """The difference of the sketches of side 0 and side 1; cells that cancel out are gone."""
    sign = F.when(F.col("side") == 0, F.col("n")).otherwise(-F.col("n"))
    return _merged(cells.select(*keys, "size", "seed", "cell", sign.alias("n"), "k", "h", F.lit(None).cast("long").alias("found")), keys)


def _merged(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    merged = cells.groupBy(*keys, "size", "seed", "cell", "found").agg(F.sum("n").alias("n"), F.expr("bit_xor(k)").alias("k"), F.expr("bit_xor(h)").alias("h"))
    return merged.where("n <> 0 OR k <> 0 OR h <> 0")


def peel(cells: DataFrame, *keys: str, turns: int = TURNS) -> DataFrame:
    """Cells left over, and a row for each digest recovered: ``found`` is the digest and ``n`` its side's sign.

    Each turn looks at one third of every sketch, where a digest has one cell only, so none is taken out twice."""
    for turn in range(turns):
        third = F.expr("size div 3")
        pure = F.col("found").isNull() & F.abs("n").eqNullSafe(1) & (F.col("h") == _check("k")) & (F.floor(F.col("cell") / third) == turn % 3)
        here = F.struct("cell", "found", "n", "k", "h")
        places = _places("k")
        nothing = F.lit(0).cast("long")
        taken = [F.struct(places[j].alias("cell"), F.col("found"), (-F.col("n")).alias("n"), F.col("k"), F.col("h")) for j in range(3)]
        shown = F.struct(nothing.alias("cell"), F.col("k").alias("found"), F.col("n"), nothing.alias("k"), nothing.alias("h"))
        moved = F.explode(F.when(pure, F.array(here, *taken, shown)).otherwise(F.array(here))).alias("x")
        cells = _merged(cells.select(*keys, "size", "seed", moved).select(*keys, "size", "seed", "x.*"), keys)
    return cells


def differences(pairs: DataFrame, size: Column, seed: int, *keys: str) -> DataFrame:
    """``(*keys, differ, left)`` of every row of ``(*keys, mine, other)``: how many digests were recovered from the
    difference of the two sketches of ``size`` cells, and how many cells are left over (0: all were recovered)."""
    together = pairs.repartition(*keys)
    sides = together.select(*keys, size.cast("long").alias("size"), F.lit(seed).alias("seed"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("mine").alias("digests")), F.struct(F.lit(1).alias("side"), F.col("other").alias("digests")))).alias("s"))
    cells = cells_of(sides.select(*keys, "size", "seed", "s.*"), *keys, "side")
    return peel(subtract(cells, *keys), *keys).groupBy(*keys).agg(
        F.count("found").alias("differ"), F.count(F.when(F.col("found").isNull(), 1)).alias("left"))


def likeness(pairs: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, near)``: the digests that two texts share, as a part of all their digests; 1 if neither has any.

    The first sketch has ``CELLS`` cells. Pairs that leave cells over are tried with sketches of twice the digests
    of both texts and a new seed, then with larger ones; after ``TRIES`` of them the digests are compared as they are."""
    total = F.size("mine") + F.size("other")
    known = []
    size: Column = F.lit(CELLS)
    for seed in range(TRIES):
        found = written(differences(pairs, size, seed, *keys), "differences")
        done = pairs.join(found, list(keys), "left").where(F.coalesce("left", F.lit(0)) == 0)
        known.append(done.select(*keys, total.alias("total"), F.coalesce("differ", F.lit(0)).alias("differ")))
        failed = found.where(F.col("left") > 0).select(*keys)
        if failed.isEmpty():
            break
        pairs = written(pairs.join(failed, list(keys)), "retried")
        size = F.lit(3) * F.ceil((total * (1 << seed) * F.lit(2) + CELLS) / 3)
    else:
        apart = F.size(F.array_except("mine", "other")) + F.size(F.array_except("other", "mine"))
        known.append(pairs.select(*keys, total.alias("total"), apart.alias("differ")))
    out = known[0]
    for more in known[1:]:
        out = out.unionByName(more)
    near = F.when(F.col("total") == 0, F.lit(1.0)).otherwise((F.col("total") - F.col("differ")) / (F.col("total") + F.col("differ")))
    return out.select(*keys, near.alias("near"))


def fingerprint(sides: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, fingerprint)``: the cells of the smallest sketch as text, each as place, number, digests and checks;
    rows without digests are not in the result."""
    cells = cells_of(sides.withColumn("size", F.lit(CELLS).cast("long")).withColumn("seed", F.lit(0)), *keys)
    told = F.struct("cell", F.concat_ws(":", "cell", "n", F.hex("k"), F.hex("h")).alias("cell_text"))
    return cells.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(told)), lambda c: c["cell_text"]), ",").alias("fingerprint"))


def followers(ids: DataFrame) -> DataFrame:
    """``(id, need, next)``: to every distinct id the next larger one, and the smallest one to the largest; null is the
    smallest. Ids are dealt by range, and only the first one of each range is looked at across ranges."""
    placed = written(ids.repartitionByRange(F.col("id").asc_nulls_first()).withColumn("bucket", F.spark_partition_id()), "ids")
    one = F.struct(F.col("id").isNotNull().alias("there"), F.col("id").alias("id"))
    inside = placed.withColumn("next", F.lead(one).over(Window.partitionBy("bucket").orderBy(F.col("id").asc_nulls_first())))
    # one row per range, not per id
    order = Window.orderBy("bucket")
    firsts = placed.groupBy("bucket").agg(F.min(one).alias("first"))
    after = firsts.select("bucket", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("after"))
    return inside.join(after, "bucket").select("id", "need", F.coalesce("next", "after")["id"].alias("next"))


def edited_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, id, n_chars, edited_sha256, own, edited, next)``: every document, the hash of its edited text, and the
    digests of its text, its edited text and the next document; ``row`` is a number of its own for each row."""
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    quarter = F.floor(F.length("text") / 4)
    ids = base.groupBy("id").agg(F.max(quarter).alias("need"))
    chain = followers(ids).select(F.col("id").alias("before"), "need", "next", F.xxhash64("next").alias("next_key"))
    ahead = base.join(chain, (F.col("key") == F.col("next_key")) & F.col("id").eqNullSafe(F.col("next"))).select(
        "before", F.xxhash64("before").alias("before_key"), F.xxhash64("text").alias("hash"),
        F.struct(F.expr("substring(text, 1, CAST(need AS INT))").alias("head"), digests(F.col("text")).alias("digests")).alias("ahead"))
    heads = ahead.groupBy("before", "before_key").agg(F.min_by("ahead", "hash").alias("ahead"))
    both = base.join(heads, (F.col("key") == F.col("before_key")) & F.col("id").eqNullSafe(F.col("before"))).withColumn("n", F.length("text"))
    edited = F.expr("concat(substring(text, 1, n - n div 4), substring(ahead.head, 1, CAST(n div 4 AS INT)))")
    made = both.select("id", F.col("n").cast("long").alias("n_chars"), "text", edited.alias("new"), F.col("ahead.digests").alias("next"))
    return made.select(
        F.monotonically_increasing_id().alias("row"), "id", "n_chars", F.sha2("new", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("new")).alias("edited"), "next")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``, one row per row of ``docs``.

    The edited text has the last quarter of the characters (code points, rounded down) replaced by as many of the next
    document's first, or all if it has fewer. The next document has the next larger id, the one with the largest id is
    followed by that with the smallest, and a null id is the smallest. Where several rows have the next id, the text with
    the smallest hash counts. A null text is empty. Repeated rows stay; equal texts have equal fingerprints; a text
    without paragraphs has an empty one. Likeness is 1 for equal texts and 0 if no paragraph is shared. A text of any
    length is read whole. An empty table gives an empty result; other columns are not read.

    Texts are shuffled once by id and meet the first quarter of their successors. Rows that repeat one id many times
    are a skewed join, which the adaptive plan splits."""
    table = written(edited_versions(docs, id_col, text_col), "versions")
    pairs = table.select("row", F.explode(F.array(
        F.struct(F.lit("edited").alias("pair"), F.col("own").alias("mine"), F.col("edited").alias("other")),
        F.struct(F.lit("next").alias("pair"), F.col("own").alias("mine"), F.col("next").alias("other")))).alias("p")).select("row", "p.*")
    near = likeness(pairs, "row", "pair").groupBy("row").agg(
        *[F.max(F.when(F.col("pair") == p, F.col("near"))).alias(f"near_{p}") for p in ("edited", "next")])
    sides = table.repartition("row").select("row", F.explode(F.array(
        *[F.struct(F.lit(s).alias("version"), F.col(s).alias("digests")) for s in ("own", "edited")])).alias("s")).select("row", "s.*")
    shown = fingerprint(sides, "row", "version").groupBy("row").agg(
        *[F.max(F.when(F.col("version") == s, F.col("fingerprint"))).alias(s) for s in ("own", "edited")])
    rows = table.select("row", "id", "n_chars", "edited_sha256").join(near, "row").join(shown, "row", "left")
    return rows.select(
        "id", "n_chars", "edited_sha256", F.coalesce("own", F.lit("")).alias("fingerprint"),
        F.coalesce("edited", F.lit("")).alias("edited_fingerprint"), "near_edited", "near_next")
