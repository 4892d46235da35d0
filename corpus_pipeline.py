"""documents -> quality rules -> exact dedup -> near dedup -> mixing -> packing.

Each stage works on all rows its predecessor kept. Between stages ``run`` writes the rows to the shared checkpoint
folder, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportlens.llm.exact_dedup import drop_exact_copies
from reportlens.llm.mixing import apply_mix
from reportlens.llm.near_dedup import drop_near_copies
from reportlens.llm.packing import pack_documents
from reportlens.llm.quality_rules import apply_quality_rules
from reportlens.llm.queries import word_vocabulary
from reportlens.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a rule; lines too common for their source go from the others."""
    return apply_quality_rules(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, 0.8 alike or more, stays."""
    return drop_near_copies(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in the order of the mix; its text is what the mix takes."""
    return apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its place in a sequence of at most 2048 tokens."""
    return pack_documents(docs, word_vocabulary())


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]
# Tokenisation and connected components are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
