"""Readers for page tables and for the file formats the writers produce."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPE_SUFFIX = {"int": "int", "long": "bigint", "float": "double", "double": "double", "boolean": "boolean"}
EMBEDDING_DDL = "chunk_id string, embedding array<double>, model_id string, embedded_at timestamp, dimensions int"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that were fetched; see ``rejected_pages`` for the rest."""
    return table(spark, folder, "pages").filter(F.col("html").isNotNull())


def read_graph_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with typed headers: columns starting with a colon go, ``name:type`` becomes ``name`` cast by
    its suffix, and edge ends become ``start_id`` and ``end_id``."""
    raw = spark.read.csv(
        path, header=True, multiLine=True, escape='"', quote='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    out = []
    for column in raw.columns:
        name, _, suffix = column.partition(":")
        source = F.col(f"`{column}`")
        if column.startswith(":START_ID"):
            out.append(source.alias("start_id"))
        elif column.startswith(":END_ID"):
            out.append(source.alias("end_id"))
        elif column == ":TYPE":
            out.append(source.alias("type"))
        elif name:
            kind = TYPE_SUFFIX.get(suffix)
            out.append((source.try_cast(kind) if kind else F.coalesce(source, F.lit(""))).alias(name))
    return raw.select(*out)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of vectors; blank lines are skipped."""
    return spark.read.schema(EMBEDDING_DDL).json(path).filter(F.col("chunk_id").isNotNull())


def read_state(spark: SparkSession, path: str, ddl: str, one_per_file: bool = True) -> tuple[DataFrame, DataFrame]:
    """Saved JSON records, and the ones that do not parse (to be reported, not to stop the run). A file
    holds one record, or one on each line."""
    raw = spark.read.option("multiLine", one_per_file).option("mode", "PERMISSIVE").schema(ddl + ", _corrupt_record string").json(path)
    named = raw.withColumn("_file", F.input_file_name())
    good = named.filter("_corrupt_record is null").drop("_corrupt_record", "_file")
    return good, named.filter("_corrupt_record is not null").select("_file", "_corrupt_record")


def read_guide(spark: SparkSession, path: str, article: str) -> DataFrame:
    """Articles of a guide written by ``write_guide_json``, with the fields of the schema ``article``.

    The document is read as lines, so no task holds more than one article: article lines begin with the
    article's id, behind a comma in all but the first of a chapter. Lines that do not parse are left out."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^,", "").alias("line"))
    found = lines.filter(F.col("line").startswith('{"article_id"')).select(F.from_json("line", article).alias("a"))
    return found.filter("a is not null").select("a.*")
