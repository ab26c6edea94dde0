"""The corpus pipeline: documents through cleaning, deduplication, mixing and packing.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perfscore.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from perfscore.llm.common import materialize, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: failing lines go, and documents that the rules reject."""
    return quality_rules.keep_clean(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: recurring templates go from all texts but the first, and documents left without words."""
    return line_dedup.without_recurring_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each near-duplicate group stays."""
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pfair mix to flattened source weights: no document goes, those of short sources come again."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-two-fit packing of the documents' tokens into sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", clean), ("line_dedup", drop_lines), ("jaccard_join", drop_near_duplicates),
          ("mixing", mix), ("packing", pack)]

#: The stages hash, pack and tokenize; SQL cannot state their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
