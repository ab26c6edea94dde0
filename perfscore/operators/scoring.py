"""Scored table: enrichment + performance + rule score + within-group z."""

from __future__ import annotations

from pyspark.sql import DataFrame
from perfscore.functions.scoring import V5, Weights, score_v5, text_length
from perfscore.functions.video import as_of_literal, performance_score
from perfscore.operators.stats import zscore_within


def with_performance(df: DataFrame, as_of: str, out: str = "performance_score") -> DataFrame:
    """Add B10 (views per day per subscriber) at a fixed ``as_of`` time."""
    return df.withColumn(out, performance_score("view_count", "published_at",
                                                "subscriber_count", as_of_literal(as_of)))


def with_rule_score(df: DataFrame, weights: Weights = V5, out: str = "thumbnail_score") -> DataFrame:
    """Add ``text_length`` (unless the rows hold it in place of the text) and the v5 rule score."""
    if "texte_contenu" in df.columns or "text_length" not in df.columns:
        df = df.withColumn("text_length", text_length("texte_contenu"))
    return df.withColumn(out, score_v5(w=weights))


def score_table(enriched: DataFrame, as_of: str, group_cols="channel_name",
                weights: Weights = V5) -> DataFrame:
    """enriched → + text_length, performance_score, thumbnail_score, perf_norm."""
    df = enriched
    if "performance_score" not in df.columns:
        df = with_performance(df, as_of)
    df = with_rule_score(df, weights)
    return zscore_within(df, "performance_score", group_cols, out="perf_norm")


__all__ = ["with_performance", "with_rule_score", "score_table"]
