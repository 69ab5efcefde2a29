"""Preparation of a training corpus in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and
returns a DataFrame; the caller writes it as Parquet and reads it again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labrelay.llm import factorisation, mixing, secrets, simhash, tiling
from labrelay.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return factorisation.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each SimHash group (three-word shingles, two bits)."""
    return simhash.simhash_dedup(docs, width=3, budget=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secrets.redacted(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, with copy (from 1)."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("mixing", mixing_sources),
]

#: SQL can't express the classifier, the fingerprints, the tiling or the forest;
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage{k}")
    return docs
