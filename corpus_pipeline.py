"""The corpus pipeline: quality rules, language identification, near-duplicate removal, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor left. SQL can express none of the models, so
there is no SQL for the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, language, mixing, quality, simhash
from tidemark.llm.common import bound_batches, new_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and both perplexity bands."""
    bound_batches(spark)
    return quality.accepted(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter or between two languages go; a missing lang becomes the prediction."""
    return language.in_a_language(docs, language.fit(language.training(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return simhash.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they were drawn."""
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the ids of the text, their number, and whether they decode to the text's bytes."""
    return bpe.add_checked_ids(docs, keep=["doc_id", "source", "lang"])


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("byte bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
