"""Entity mentions: gazetteer matching with offsets, joins to chunks, merging to entities."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.bits import bitmap
from pageloom.functions.text import ENTITY_TYPES, confidence, entity_id, stringify
from pageloom.operators.chunks import SUMMARY
from pageloom.session import light, prefer, written

#: Lossless split into letter runs and what lies between them.
PIECE = r"\p{L}+|[^\p{L}]+"
#: Words that a batch holds before it is handed on.
FLUSH = 50_000
#: Bits of the bitmap of first words at most (16 MB), and bits for each word of a smaller gazetteer.
BITS, BITS_EACH = 1 << 27, 16
#: Words whose place in the bitmap a worker remembers.
KNOWN = 100_000


def first_words(names: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap of the hashes of the column ``word``, and its number of bits: a power of two that grows with the words,
    at most ``BITS``. Only the bitmap itself comes to the driver. It may let other words pass and stops none of these."""
    n = names.agg(F.approx_count_distinct("word").alias("n")).first()["n"]
    bits = min(BITS, 1 << max(12, (n * BITS_EACH).bit_length()))
    at = F.crc32(F.encode("word", "UTF-8")).bitwiseAND(bits - 1).alias("at")
    return bitmap(names.where("word IS NOT NULL").select(at), bits), bits


def words_with_offsets(df: DataFrame, text: str, lookahead: int = 0, wanted: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """One row per word: ``word`` (lower case), ``source_text``, ``start_pos`` and, with a lookahead,
    ``ahead``: the pieces up to ``lookahead`` words further. Pieces of letters and of other characters
    take turns, so one split and one running sum of lengths per text give all words; time is linear in
    the text. Batches leave as they are filled; there is no window and no shuffle. With ``wanted``, of the words in
    ASCII letters only those come that the bitmap of ``first_words`` holds; all others come as before."""
    carried = [c for c in df.columns if c != text]
    rows = df.filter(F.length(text) > 0).select(*carried, F.col(text).alias("_text"))
    shared = df.sparkSession.sparkContext.broadcast(wanted) if wanted else None
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_text"] + [
        T.StructField("source_text", T.StringType()), T.StructField("start_pos", T.IntegerType())]
        + ([T.StructField("ahead", T.ArrayType(T.StringType()))] if lookahead else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, letter = regex.compile(PIECE), regex.compile(r"\p{L}")
        known: dict[str, bool] = {}

        def held(word: str) -> bool:
            if (found := known.get(word)) is None:
                filled, bits = shared.value
                at = zlib.crc32(word.lower().encode()) & (bits - 1)
                found = not word.isascii() or bool(filled[at >> 3] >> (at & 7) & 1)
                if len(known) >= KNOWN:
                    known.clear()
                known[word] = found
            return found

        for batch in batches:
            keys = batch.select(carried)
            owners, words, starts, ahead = [], [], [], []

            def flush():
                own = np.repeat(np.array([o for o, _ in owners], np.int64), [n for _, n in owners])
                columns = [keys.column(i).take(pa.array(own)) for i in range(len(carried))]
                columns += [pa.array(words, pa.string()), pa.array(np.concatenate(starts).astype(np.int32))]
                return pa.RecordBatch.from_arrays(columns + ([pa.array(ahead, pa.list_(pa.string()))] if lookahead else []), schema.names)

            for i, value in enumerate(batch.column(len(carried))):
                pieces = pattern.findall(value.as_py())
                first = 0 if letter.match(pieces[0]) else 1
                at = range(first, len(pieces), 2)
                if shared:
                    at = [k for k in at if held(pieces[k])]
                if not len(at):
                    continue
                owners.append((i, len(at)))
                words.extend(pieces[k] for k in at)
                sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
                starts.append((np.cumsum(sizes) - sizes)[np.array(at)])
                if lookahead:
                    ahead.extend(pieces[k + 1 : k + 1 + 2 * lookahead] for k in at)
                if len(words) >= FLUSH:
                    yield flush()
                    owners, words, starts, ahead = [], [], [], []
            if words:
                yield flush()

    return rows.mapInArrow(read, schema).withColumn("word", F.lower("source_text"))


def extract_mentions(
    articles: DataFrame, gazetteer: DataFrame, text: str = "markdown_content", max_words: int | None = None
) -> DataFrame:
    """Occurrences of gazetteer names in article text. ``gazetteer(name, entity_type)`` holds lower-case
    names; several words are parted by single blanks.

    The gazetteer is written first and goes to all tasks if it is ``light``; the words then stay where they are.
    Otherwise both sides hash on the whole name: each word offers itself and what follows it, up to ``max_words`` words,
    so names that share a frequent first word do not meet all its occurrences. In both forms only words that may begin a
    name leave the text. Skewed partitions of frequent words are split by Spark."""
    listed = written(gazetteer.select("name", "entity_type"), "names")
    widest = listed.agg(F.max(F.size(F.split("name", " "))).alias("n")).first()["n"] or 1
    max_words = max_words or widest
    carried = ["article_id", "chapter_number", "article_number"]
    names = light(listed).withColumn("word", F.split_part(F.col("name"), F.lit(" "), F.lit(1)))
    words = words_with_offsets(articles.select(*carried, text), text, max_words - 1, first_words(names))
    source = F.col("source_text")
    if max_words == widest == 1:
        hits = words.withColumnRenamed("word", "name").join(names.drop("word"), "name")
    elif max_words == 1:
        hits = words.join(names, "word")
    else:
        offers = F.array(*[F.struct(
            F.lit(n).alias("n"), F.concat(source, F.array_join(F.slice("ahead", 1, 2 * n - 2), "")).alias("whole")) for n in range(1, max_words + 1)])
        offered = words.withColumn("_offer", F.explode(offers)).select(
            *carried, "start_pos", "word", F.col("_offer.n").alias("_n"), F.col("_offer.whole").alias("_whole"), F.lower("_offer.whole").alias("name"))
        hits = offered.join(names.withColumn("_n", F.size(F.split("name", " "))), ["name", "_n", "word"])
        source = F.col("_whole")
    return hits.select(
        *carried, F.col("start_pos").alias("position"), "entity_type", "name", source.alias("source_text"), "start_pos",
        (F.col("start_pos") + F.length(source)).alias("end_pos"),
        F.create_map(F.lit("matched"), source).alias("attributes"),
        F.when(source == F.col("name"), "match_exact").otherwise("match_fuzzy").alias("alignment_status"),
    ).withColumn("entity_id", entity_id(F.col("entity_type"), F.col("name"))).withColumn(
        "confidence", confidence(F.col("alignment_status"))
    )


def extract_mentions_with(articles: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
    """Plug-in form: ``fn`` gets batches of ``(article_id, chapter_number, article_number,
    markdown_content)`` and yields raw extractions; ``valid_mentions`` turns them into mentions."""
    ddl = (
        "article_id string, chapter_number int, article_number int, position int, extraction_class string, "
        "extraction_text string, start_pos int, end_pos int, alignment_status string, attributes map<string,array<string>>"
    )
    return articles.select("article_id", "chapter_number", "article_number", "markdown_content").mapInPandas(fn, ddl)


def known_types(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Drop rows of unknown class."""
    return df.filter(F.col(column).isin(allowed))


def valid_mentions(raw: DataFrame) -> DataFrame:
    """Raw extractions to mentions: unknown classes go, ids, confidence and text attributes come."""
    df = known_types(raw.withColumn("entity_type", F.lower("extraction_class")), "entity_type", ENTITY_TYPES)
    status = F.coalesce(F.nullif(F.col("alignment_status"), F.lit("")), F.lit("exact"))
    return df.select(
        "article_id", "chapter_number", "article_number", "position", "entity_type",
        F.col("extraction_text").alias("name"), F.col("extraction_text").alias("source_text"), "start_pos", "end_pos",
        stringify(F.coalesce("attributes", F.create_map().cast("map<string,array<string>>"))).alias("attributes"),
        status.alias("alignment_status"), entity_id(F.col("entity_type"), F.col("extraction_text")).alias("entity_id"),
        confidence(status).alias("confidence"),
    )


def _stretches(start, end, width: int):
    """Numbers of the stretches of ``width`` characters that a span touches."""
    return F.sequence(F.floor(start / width), F.floor(F.greatest(start, end - 1) / width))


def _meet(width: int):
    """Condition that a chunk and a mention share characters and meet in the first stretch both touch."""
    first_shared = F.floor(F.greatest("char_start", "start_pos") / width)
    return (F.col("start_pos") < F.col("char_end")) & (F.col("end_pos") > F.col("char_start")) & (F.col("_at") == first_shared)


def overlap_join(chunks: DataFrame, mentions: DataFrame, width: int = 2048) -> DataFrame:
    """Chunk and mention pairs of one article that share characters. Both sides are cut into stretches
    of ``width`` characters and joined on article and stretch, so even one huge article spreads over
    many tasks; a pair is kept only in the first stretch both touch, so nothing repeats."""
    c = chunks.select("chunk_id", F.col("source_article_id").alias("article_id"), "char_start", "char_end")
    c = c.filter(F.col("char_start").isNotNull() & F.col("char_end").isNotNull())
    m = mentions.select("article_id", "entity_id", "position", "start_pos", "end_pos")
    m = m.filter(F.col("start_pos").isNotNull() & F.col("end_pos").isNotNull())
    c = c.withColumn("_at", F.explode(_stretches(F.col("char_start"), F.col("char_end"), width)))
    m = m.withColumn("_at", F.explode(_stretches(F.col("start_pos"), F.col("end_pos"), width)))
    return c.join(m, ["article_id", "_at"]).filter(_meet(width)).drop("_at")


def link_mentions(chunks: DataFrame, mentions: DataFrame, width: int = 2048, parts: int = 16) -> DataFrame:
    """``(chunk_id, source_article_id, entity_id, position, end_pos)``: text chunks by character range,
    summary chunks to every mention of the article, with or without a place. Repeated mentions repeat.

    One join on article and stretch serves both, so chunks and mentions are read once. Both are dealt by article before they
    are cut into stretches, so each moves once (not at all if ``dealt``), and so do not the links where they are grouped within
    articles. A summary stands in ``parts`` stretches below zero, and each mention goes to one of them by its own stretch.
    An article's links are made in one task, as its chunks are. Mentions and chunks without an article link with nothing.
    Sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false as ``resolve_relationships`` does."""
    prefer(chunks.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false")
    start, end = F.col("char_start"), F.col("char_end")
    nowhere = F.array().cast("array<bigint>")
    c = chunks.select("chunk_id", F.col("source_article_id").alias("article_id"), "char_start", "char_end", "chunk_type").filter(
        "article_id is not null").repartition("article_id").select("chunk_id", "article_id", "char_start", "char_end", F.explode(
        F.when(F.col("chunk_type") == SUMMARY, F.sequence(F.lit(-parts).cast("long"), F.lit(-1).cast("long")))
        .when(start.isNotNull() & end.isNotNull(), _stretches(start, end, width)).otherwise(nowhere)).alias("_at"))
    start, end = F.col("start_pos"), F.col("end_pos")
    home = -1 - F.pmod(F.coalesce(F.floor(start / width), F.lit(0).cast("long")), F.lit(parts))
    m = mentions.select("article_id", "entity_id", "position", "start_pos", "end_pos").filter(
        "article_id is not null").repartition("article_id").select("*", F.explode(F.concat(
        F.array(home), F.when(start.isNotNull() & end.isNotNull(), _stretches(start, end, width)).otherwise(nowhere))).alias("_at"))
    return c.join(m, ["article_id", "_at"]).filter((F.col("_at") < 0) | _meet(width)).select(
        "chunk_id", F.col("article_id").alias("source_article_id"), "entity_id", "position", "end_pos")


def merge_entities(mentions: DataFrame) -> DataFrame:
    """One row per entity: first occurrence's columns, highest confidence, attributes merged with the
    later value winning per key. Every step combines map-side, so common entities do not pile up."""
    order = F.struct("chapter_number", "article_number", "position")
    core = [
        "entity_type", "name", "source_text", "start_pos", "end_pos", "article_id", "alignment_status",
        "chapter_number", "article_number", "position",
    ]
    merged = mentions.groupBy("entity_id").agg(
        F.min_by(F.struct(*core), order).alias("c"), F.max("confidence").alias("confidence")
    )
    pairs = mentions.select("entity_id", order.alias("_o"), F.explode("attributes").alias("key", "value"))
    latest = pairs.groupBy("entity_id", "key").agg(F.max_by("value", "_o").alias("value"))
    maps = latest.groupBy("entity_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("attributes")
    )
    named = [F.col(f"c.{x}").alias("source_article_id" if x == "article_id" else x) for x in core]
    return merged.join(maps, "entity_id", "left").select(
        "entity_id", *named, "confidence",
        F.coalesce("attributes", F.create_map().cast("map<string,string>")).alias("attributes"),
    )


def entity_names(mentions: DataFrame) -> DataFrame:
    """``(entity_id, name)`` as in ``merge_entities``. The place of a mention is one whole number, for which Spark combines in
    hash maps where it would sort all mentions for a struct; one row per entity and name is left for picking the first."""
    place = F.lit(0).cast("decimal(38,0)")
    for column in ("chapter_number", "article_number", "position"):
        number = F.coalesce(F.col(column).cast("long") + F.lit(1 << 31) + 1, F.lit(0).cast("long"))
        place = (place * F.lit(10**10) + number).cast("decimal(38,0)")
    found = mentions.groupBy("entity_id", "name").agg(F.min(place).alias("_at"))
    return found.groupBy("entity_id").agg(F.min_by("name", "_at").alias("name"))


def entities_by_type(df: DataFrame, entity_type: str) -> DataFrame:
    return df.filter(F.col("entity_type") == entity_type)
