"""Text, id and label expressions. Everything here is a Column expression that stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java needs (?U) for \s and \S to cover Unicode spaces such as NBSP.
NON_SPACE = r"(?U)\S+"
SPACES = r"(?U)\s+"
EDGE_SPACES = r"(?U)^\s+|\s+\z"
# Fixed value: characters that a text may not hold.
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"

# The closed sets of entity and relationship types.
ENTITY_TYPES = [
    "concept", "methodology", "tool", "standard", "challenge",
    "best_practice", "role", "industry", "artifact", "process_stage",
]
RELATIONSHIP_TYPES = [
    "DEFINES", "MENTIONS", "PREREQUISITE_FOR", "COMPONENT_OF", "ADDRESSES", "DEMONSTRATES",
    "REQUIRES", "RELATED_TO", "ALTERNATIVE_TO", "USED_BY", "APPLIES_TO", "PRODUCES",
]


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only knows the blank)."""
    return F.regexp_replace(c, EDGE_SPACES, "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(NON_SPACE)), F.lit(0)).cast("long")


def char_count(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0)).cast("long")


def normalise(c: Column) -> Column:
    """Delete control characters, fold whitespace runs to one blank, strip."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, CONTROL_CHARS, ""), SPACES, " "))


def estimate_tokens(c: Column, chars_per_token: float = 4.0) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / F.lit(chars_per_token))).cast("long")


def cap(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def lead_summary(c: Column) -> Column:
    """Summary used when no model summary exists: the first 200 characters and an ellipsis."""
    return F.concat(strip(cap(c, 200)), F.lit("..."))


def entity_id(entity_type: Column, name: Column) -> Column:
    return F.concat_ws("-", entity_type, F.substring(F.md5(strip(F.lower(name))), 1, 8))


def relationship_id(src: Column, rel_type: Column, dst: Column) -> Column:
    return F.concat(F.lit("rel-"), F.substring(F.md5(F.concat_ws("-", src, rel_type, dst)), 1, 12))


def chunk_id(article_id: Column, chunk_type: Column, index: Column, sub_index: Column) -> Column:
    section = F.concat(article_id, F.lit("-sec"), index.cast("string"))
    return (
        F.when(chunk_type.isin("summary", "article_summary"), F.concat(article_id, F.lit("-summary")))
        .when(chunk_type == "section", section)
        .when(
            (chunk_type == "sliding_window") & sub_index.isNotNull(),
            F.concat(section, F.lit("-sw"), sub_index.cast("string")),
        )
        .otherwise(F.raise_error(F.concat(F.lit("no chunk id rule for type "), chunk_type)).cast("string"))
    )


def article_id(chapter: Column, article: Column) -> Column:
    return F.concat(F.lit("ch"), chapter.cast("string"), F.lit("-art"), article.cast("string"))


def chapter_of(article: Column) -> Column:
    """Chapter number out of ``ch<N>-...``; null when it does not parse."""
    return F.substring(F.split_part(article, F.lit("-"), F.lit(1)), 3, 20).try_cast("int")


def type_label(c: Column) -> Column:
    """``best_practice`` becomes ``Bestpractice``."""
    return F.initcap(F.regexp_replace(c, "_", ""))


def escape(c: Column, newline: str = " ") -> Column:
    """Escape text for a single-quoted statement literal; node scripts turn newlines into
    blanks, chunk scripts into a backslash and an n."""
    c = F.coalesce(c, F.lit(""))
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("'"), F.lit("\\'"))
    return F.replace(c, F.lit("\n"), F.lit(newline))


def confidence(alignment_status: Column) -> Column:
    status = F.lower(alignment_status)
    return F.when(status.contains("fuzzy"), 0.8).when(status.contains("no_match"), 0.5).otherwise(1.0)


def stringify(attributes: Column) -> Column:
    """``map<string, array<string>>`` to ``map<string, string>`` with lists joined by a comma."""
    return F.transform_values(attributes, lambda _, v: F.array_join(v, ", "))


def content_type(article_number: Column) -> Column:
    return F.when(article_number == 0, "chapter_overview").otherwise("article")
