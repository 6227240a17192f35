"""The corpus pipeline: language ID, exact dedup, near-duplicate join, mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metrolens.llm import exact_dedup, jaccard_join, langid, mixing, packing
from metrolens.llm.common import stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    return langid.keep_identified(docs, langid.train(docs, hold_out=False))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that links of five-word Jaccard >= 0.8 join, one stays."""
    return jaccard_join.kept_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of their weights."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 1024 tokens. The workers serve other stages too, so
    they do not remember words between tasks."""
    return packing.pack(docs, with_ids=False, remember=False)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: Language ID and tokenising have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over `documents`; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
