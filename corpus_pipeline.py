"""The corpus pipeline: five stages from raw documents to token files."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import mixing, near_duplicates, phrase_index, quality, token_files
from rowloom.llm.common import limit_batches, small_batches, table
from rowloom.llm.queries import tokenizer_path
from rowloom.plans.scratch import materialize, scratch_path

#: Chunks of text that a worker of the last stage remembers, in each of two generations.  Memory is what the
#: pipeline is short of, as its executors still hold what the stages before have left.
REMEMBERED_CHUNKS = 150_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """Limits the rows of a batch to Python before a stage.

    What a stage returns is still to be written, so the limit stays in the session; ``run`` takes it back.
    """

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark)
        return stage(spark, docs, sf_dir)

    return limited


@in_small_batches
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted_documents(docs, table(spark, sf_dir, "labels"))


@in_small_batches
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicates.distinct_documents(docs)


@in_small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return phrase_index.clean_documents(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, kept or left out so that sources meet their target weights."""
    return mixing.mixed_documents(docs)


@in_small_batches
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: place, length and digest of each."""
    path = scratch_path(spark, "pipeline-tokens")
    token_files.write(docs, path, tokenizer_path(), remembered=REMEMBERED_CHUNKS)
    return token_files.digest(token_files.read(spark, path))


STAGES = [
    ("quality classifier", classify),
    ("near-duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token files", tokenize),
]

#: The classifier is learned, so no SQL gives these rows; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
