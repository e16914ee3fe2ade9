"""Corpus preparation as stages over ``documents``; each stage works on all that its predecessor kept."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchpath.llm import decontamination, mixing, quality_rules, queries, secret_scan, simhash_dedup  # noqa: E402
from touchpath.llm.common import stage  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no certified rule rejects.

    The measures are taken once for the cutoffs and once more beside the texts,
    which is cheaper than shuffling the texts to the verdicts.
    """
    measured = stage(quality_rules.with_measures(docs, keep=["doc_id", "lang"]), "measures")
    cutoffs = quality_rules.select_cutoffs(measured, queries.table(spark, sf_dir, "labels"))
    return quality_rules.filter_documents(docs, cutoffs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest id."""
    return simhash_dedup.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text becomes ``[SECRET]``; ``n_chars`` follows."""
    return secret_scan.redact_secrets(docs, length_col="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: doc_id, size, source_size, target and the words taken of each document."""
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Stage]] = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontaminated),
                                   ("secret_scans", secrets), ("source_mixing", mixed)]

#: No stage's method can be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written as Parquet and read back."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
