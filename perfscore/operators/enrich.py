"""Merge and enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.operators.joins import small_side
from perfscore.functions.features import (DEFAULT_CHANNEL_AVG_PERF, DEFAULT_NICHE,
                                          DEFAULT_SUBSCRIBERS)


def merge_labels(videos: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    """videos ⋈ labels on video_id (left by default: unlabelled videos stay)."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    return videos.join(labels, "video_id", how)


def keep_with_embedding(df: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Rows that have an embedding (semi-join: only the key column is read)."""
    return df.join(embeddings.select("video_id"), "video_id", "left_semi")


def attach_embedding(df: DataFrame, embeddings: DataFrame, dim: int | None = None) -> DataFrame:
    """Inner join with the embedding table, adding ``dim``; other lengths than a given one
    are left out (``wrong_dimension`` lists them)."""
    out = df.join(embeddings, "video_id").withColumn("dim", F.size("embedding"))
    if dim is not None:
        out = out.where(F.col("dim") == dim)
    return out


def wrong_dimension(embeddings: DataFrame, dim: int) -> DataFrame:
    """Vectors of another length, as error rows."""
    size = F.size("embedding")
    return embeddings.where(F.col("embedding").isNotNull() & (size != dim)).select(
        "video_id", F.concat(F.lit("embedding has length "), size).alias("error"))


def missing_assets(videos: DataFrame, images: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` videos (by id) with no image file, with the counts of both sides."""
    missing = small_side(videos.select("video_id").join(images.select("video_id"), "video_id", "left_anti"))
    n = lambda df: df.select(F.count(F.lit(1))).scalar()  # noqa: E731  (scalar subquery)
    first = missing.orderBy("video_id").limit(k)
    return first.select("video_id", n(missing).alias("n_missing"), n(videos).alias("n_videos"),
                        n(images).alias("n_images"))


def scoring_defaults(df: DataFrame, subscribers: str = "subscriber_count",
                     channel_avg: str = "channel_avg_perf", niche: str = "niche") -> DataFrame:
    """Fill missing request values with the service defaults."""
    return (df.withColumn(subscribers, F.coalesce(F.col(subscribers), F.lit(DEFAULT_SUBSCRIBERS).cast("bigint")))
            .withColumn(channel_avg, F.coalesce(F.col(channel_avg), F.lit(DEFAULT_CHANNEL_AVG_PERF)))
            .withColumn(niche, F.coalesce(F.col(niche), F.lit(DEFAULT_NICHE))))
