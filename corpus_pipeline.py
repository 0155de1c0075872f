"""The training-data pipeline: each stage reads all that the one before it kept.

Quality rules, near duplicates, benchmark decontamination, sampling to target
shares, token output. Every stage but the last returns the columns of its input;
every one is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import contamination, mixing, near_duplicates, repetition, tokens
from tidemark.llm.common import table, written
from tidemark.llm.queries import END_ID, TOKENIZER
from tidemark.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule on length or repetition go."""
    return repetition.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return near_duplicates.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of half the tokens whose sources, languages and topics have their target shares."""
    return mixing.sample(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token folder of what is left; a row per document, as read back from it."""
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, TOKENIZER, END_ID)
    return tokens.read_digests(spark, path)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("write_tokens", write_tokens)]

#: Suffix sorting, alignment and tokenisation have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
