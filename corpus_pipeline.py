"""A document table cleaned and packed in stages, each by one operator of ``pageloom.llm``.

All stages but the last return the columns of their input. Rows that share a ``doc_id`` stay or go together
in the near-duplicate stage. Null texts and null ids pass the filters; an empty table passes all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.jaccard import jaccard_components
from pageloom.llm.leaks import without_leaks
from pageloom.llm.packing import pack_documents
from pageloom.llm.substrings import dedup_substrings
from pageloom.llm.toxicity import score_texts, train_on
from pageloom.session import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model learns from up to 1,000 labelled documents of each class."""
    model = train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), most=1000)
    return score_texts(docs, model).where("score < 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of links at a similarity of 0.75 the document with the smallest id stays."""
    later = jaccard_components(docs).where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(later, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows of 20 that occur earlier go. A text that loses words becomes its kept words joined by
    blanks, a document without any left keeps an empty text, and all other texts stay as they are. All other
    columns stay with their row; ``n_chars`` follows the text."""
    others = tuple(c for c in docs.columns if c != "text")
    found = dedup_substrings(docs, carry=others)
    less = F.col("n_removed") > 0

    def column(name: str):
        if name == "text":
            return F.when(less, F.col("kept")).otherwise(F.col("text"))
        if name == "n_chars":
            return F.when(less, F.length("kept").cast(docs.schema[name].dataType)).otherwise(F.col("row")[name])
        return F.col("row")[name]

    return found.select(*[column(c).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 tokens with their places in sequences."""
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: A kernel machine, an edit distance search and a tokenizer have no SQL form; tests/llm/test_pipeline.py
#: compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
