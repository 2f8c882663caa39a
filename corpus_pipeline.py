"""A training-data pipeline over `documents`: what is kept of a corpus, ready to be packed and read.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Its result
is written as Parquet and read again as the next stage's `docs`. All but the last keep the columns
of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import lines, ngram_join, packing, quality, substrings
from quayside.llm.common import dropping, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels outside its held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, quality.remainder("doc_id", 5) != 0)
    return quality.good_only(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier one, however few their words; blank lines stay.

    A document that loses all its lines stays, without text.
    """
    return lines.without_repeats(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id."""
    return ngram_join.one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word passages that start earlier."""
    return substrings.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", packing_stage),
]

#: Compression, tokenizing and packing have no SQL; tests/llm/test_pipeline_stages.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # what a stage wrote on its way goes once its result is written, or has failed
        with dropping(spark) as keep:
            docs = keep(stored(stage(spark, docs, sf_dir), name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
