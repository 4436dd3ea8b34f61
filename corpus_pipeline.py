"""A corpus pipeline: each stage works on all that its predecessor kept.

A stage is a function of (spark, docs, sf_dir) that returns a DataFrame.  run()
writes what a stage returns to the shared folder and hands the written table to
the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm import decontaminate, language, mixing, simhash, token_files
from rowmill.llm.base import stage, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language."""
    return language.recognised(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash component."""
    return simhash.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, described from the files."""
    return token_files.round_trip(docs, token_files.default_tokenizer())


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", uncontaminated),
    ("mixing", mixed_sources),
    ("token_files", token_ids),
]

# The stages learn, hash with XXH64, draw and tokenize: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
