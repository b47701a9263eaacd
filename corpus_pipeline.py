"""The corpus pipeline: five stages, each on all that the one before it kept.

Toxic documents go, exact copies go, one document of each group of near copies stays, documents
that hold a test item go, and what is left is packed into sequences. A filter names rows by their
place in the stored table that it is given, so ids may repeat or be NULL. Every stage but the last
returns the columns of ``documents``; each stage's rows are written and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pelagia.llm.common import Scratch, table
from pelagia.llm.decontam import drop_contaminated
from pelagia.llm.exact_dedup import drop_copies
from pelagia.llm.near_dedup import drop_near_copies
from pelagia.llm.packing import pack_documents
from pelagia.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs, stored=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, stored=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), stored=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The scores, alignments and packings have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
