"""The corpus pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenura.llm.gam import keep_good
from tenura.llm.jaccard import Rule, first_of_groups
from tenura.llm.mix import mixed_documents
from tenura.llm.pack import pack
from tenura.llm.suffix import without_repeats
from tenura.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model keeps; all where the labels don't fit one."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return first_of_groups(docs, Rule(words=5, percent=80))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes and more that an earlier document has."""
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix of sources takes."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all token sequences, with their ids."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mixing),
    ("packing", packing),
]

#: Trained models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
