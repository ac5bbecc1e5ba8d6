"""From raw documents to packed training sequences; every stage is one operator of `marketlake.llm`.

Each stage works on all that the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import exact, langid, mixing, neardup, packing
from marketlake.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those for which no language stands out."""
    return langid.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then the one with the smallest doc_id."""
    return exact.survivors(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles, the one with the smallest doc_id stays."""
    return neardup.representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one a shard is cut to its first words."""
    return mixing.mixture(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.summary(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# Language ID and packing are not SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
