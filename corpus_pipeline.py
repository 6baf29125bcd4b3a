"""A training-data pipeline over ``documents``: quality, repeated lines, near copies, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalspan.llm import fuzzy_lines, lsh_forest, pack_squares, quality_qda, quality_rules
from vitalspan.llm.common import written
from vitalspan.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fences of their language and source."""
    return quality_rules.accepted(docs)


def by_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of all labelled documents takes for good.

    It is fitted on the whole labelled table, as the rules before leave few bad documents.
    """
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_qda.accepted(docs, labelled, labels)


def by_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand elsewhere; those of which nothing is left go."""
    return fuzzy_lines.accepted(docs)


def by_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link."""
    return lsh_forest.accepted(docs, size=5, percent=80)


def by_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed."""
    return pack_squares.pack(docs, vocabulary("byte_bpe_50k.json"), with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", by_quality_rules),
    ("quality classifier", by_quality_classifier),
    ("line dedup", by_line_dedup),
    ("near dedup", by_near_dedup),
    ("packing", by_packing),
]

#: Tokens, trained models and components can't be expressed in SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before kept, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
