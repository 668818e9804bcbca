"""Corpus pipeline: quality rules, language identification, near-duplicate removal, decontamination, mixing.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all that its predecessor kept; between stages the
rows are written as Parquet in the shared folder and read again. All stages but the last return the columns of
``documents`` unchanged; the last adds ``size``, ``source_size``, ``target`` and ``taken``, and returns the documents that the
mix takes words of.

Defined results: an empty table passes through every stage; extra columns of the input stay, but for any named like one that the
last stage adds, which it replaces; rows with null texts fail the quality rules. Stages that run Python leave the session with
batches of at most ``BATCH_BYTES``, or one row if that is larger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import decontamination, language_id, mixing, quality_rules, similarity_join
from skyloom.session import durable

BATCH_BYTES = 1 << 21  # of texts that a task and its Python worker each hold in flight


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, which has to stay so until a stage's rows have been read."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the production policy."""
    small_batches(spark)
    return quality_rules.keep_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; profiles are learned from the labelled rows outside the held-out fold."""
    small_batches(spark)
    profiles = durable(language_id.learn_profiles(language_id.training_rows(docs)), "profiles")
    return language_id.keep_identified(docs, profiles)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (five-word shingles, Jaccard similarity 0.8 or more)."""
    small_batches(spark)
    return similarity_join.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_batches(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document with the words taken of it, repeats counted."""
    mixed = mixing.mix(docs, tuple(docs.columns)).where("taken > 0")
    added = ("size", "source_size", "target", "taken")
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in added]
    return mixed.select(*kept, *added)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
]

#: Rank profiles, edit matching and seeded sampling have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
