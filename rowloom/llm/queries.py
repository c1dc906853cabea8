"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import (
    chat_tree, gif_media, mixing, near_duplicates, phrase_index, pii, quality, recurrent_lm, resampling, spelling_groups,
    token_files, toxicity, url_rules,
)
from rowloom.llm.common import table
from rowloom.plans.scratch import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op5_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-probability by the counts and by the network."""
    return recurrent_lm.scored(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and digest, read back from the token files."""
    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.digest(token_files.read(spark, path))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return phrase_index.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a GIF and read back."""
    return gif_media.features(gif_media.store(table(spark, sf_dir, "documents")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by both views."""
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight, score and place in the draw."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word's form and root."""
    return spelling_groups.spelling_groups(table(spark, sf_dir, "documents"))


def op13_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, read back from prefix-tree packs."""
    return chat_tree.formatted(spark, table(spark, sf_dir, "conversations"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_recurrent_lm": op5_recurrent_lm,
    "op6_token_files": op6_token_files,
    "op7_decontamination": op7_decontamination,
    "op8_gif": op8_gif,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_resampling": op11_resampling,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_chat_tree": op13_chat_tree,
}

ORACLES: dict[str, str] = {
    "op2_mixing": mixing.MIX_SQL,
    "op10_pii": pii.PII_SQL,
    "op11_resampling": resampling.RESAMPLING_SQL,
    "op12_spelling_groups": spelling_groups.SPELLING_SQL,
    "op13_chat_tree": chat_tree.CHAT_SQL,
}
