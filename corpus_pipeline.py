"""From raw documents to a training mix: five stages over all documents, each stored and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from marketlake.llm.common import read, stored

#: Every stage judges the text as a whole; SQL cannot express the classifier or the near-duplicate search.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier chain rejects."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.keep_one_each(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep_one_each(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark phrase."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each remaining document; 0 words where it takes none."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stored in the shared folder and read again as the next one's documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
