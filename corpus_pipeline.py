"""The corpus pipeline: stages over ``documents``, each calling one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelflife.llm import decontaminate, exact, language, mixing, near
from shelflife.llm.shared import run_folder, stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (null, or without a letter) go; others stay, whatever theirs."""
    found = language.predict(docs, language.train(docs), with_doc=True)
    return found.where("lang_pred != 'und'").select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text stays, the one with the largest id."""
    return exact.exact_deduped(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id.

    A group is linked by SimHash fingerprints, and by five-word shingles with a similarity of 0.8.
    """
    return near.near_deduped(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are at least a twentieth benchmark text go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How much of every document is taken, and the places of all its copies, by the first."""
    mixed = mixing.mixture(docs).where("taken > 0")
    return mixing.document_order(mixed).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read again by the next."""
    folder = run_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"{folder}/{i}-{name}")
    return docs
