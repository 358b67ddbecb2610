"""A training corpus from ``documents``: five stages, each on what the one before kept.

Each stage takes ``(spark, docs, sf_dir)``, calls one training-data operator
and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hypercube.llm.common import table, written
from hypercube.llm.language import keep_identified
from hypercube.llm.line_dedup import drop_boilerplate
from hypercube.llm.mixing import mixed_documents, quality_weights
from hypercube.llm.packing import pack, tokenizer_path
from hypercube.llm.simhash import keep_one_per_group


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (no letter in the text, or no text) go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its documents' texts; every document stays."""
    return drop_boilerplate(docs, "source")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    return keep_one_per_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, by the sources' weights and the labels' quality."""
    return mixed_documents(docs, quality_weights(table(spark, sf_dir, "labels")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the ids of every document of the mix lie in sequences of 2048; repeats are documents of their own."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Language profiles, SimHash components and retrieval packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
