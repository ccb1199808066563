"""A training corpus from raw documents: filter, deduplicate, decontaminate, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.llm import combination_join, neighbour_vote, rule_cascade, string_tiling, tier_packing
from legwise.llm.queries import TOKENIZER, remainder
from legwise.llm.registry import table
from legwise.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base gate and every quality rule."""
    return rule_cascade.keep(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the vote of labelled documents, learnt from the raw table, calls good."""
    space = neighbour_vote.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(5) != 0)
    return neighbour_vote.keep(docs, space)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of linked documents."""
    return combination_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not cover a benchmark item."""
    return string_tiling.remove(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in windows of several lengths."""
    return tier_packing.pack(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier and the tiling have no SQL; the tests hold ``run`` against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
