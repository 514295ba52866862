"""A training corpus from documents: judged, freed of near copies and repeated passages, mixed, encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import bpe, mixing, near_dedup, quality, substring_dedup
from caseloom.llm.frames import table
from caseloom.llm.queries import tokenizer_file
from caseloom.session import cut_lineage

ORACLE_SQL = None  # a trained classifier and hashed signatures have no SQL; tests compare the stages with brute force


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more), the smallest id."""
    return near_dedup.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    return substring_dedup.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, no document twice: the largest sources give way first."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their BPE ids and the text these decode to."""
    return bpe.encoded(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("mixing", source_mix),
    ("bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
