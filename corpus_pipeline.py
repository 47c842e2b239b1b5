"""A training corpus from raw documents: five stages, each over all rows its predecessor kept.

In every stage a null text counts as empty, a null id is a row of its own kind, and only the columns of documents
are carried, so others can't clash. Equal rows are one row from the exact dedup on, until the mix takes a
row more than once. An empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm import exact, jaccard, mixing, packing, quality
from stocktide.llm.text import read_table
from stocktide.session import staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the compression classifier rejects go."""
    return quality.accepted_rows(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the greatest id stays."""
    return exact.kept_rows(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by five-word Jaccard similarity of 0.8, looked for by Golay keys of fingerprints
    and by bands, the row with the smallest id stays."""
    return jaccard.kept_rows(docs)


def take_the_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the mix takes, each as often as it is taken."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality", keep_good),
    ("exact dedup", keep_one_of_equal),
    ("near dedup", keep_one_of_near),
    ("mix", take_the_mix),
    ("pack", pack_sequences),
]

#: Shingle links, seeded mixing and genetic packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
