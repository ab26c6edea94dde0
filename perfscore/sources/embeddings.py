"""Embedding table source (A8): id + ``ARRAY<FLOAT>`` joined by key, not position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def embedding_table(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dim: int | None = None, extra=("label",)) -> DataFrame:
    """``video_id STRING, embedding ARRAY<FLOAT>, dim INT, valid BOOLEAN`` (+ extras).

    ``valid`` is false when the vector is missing or its length is not ``dim``.
    """
    size = F.size(F.col(vector_col))
    valid = F.col(vector_col).isNotNull() & ((size == dim) if dim is not None else F.lit(True))
    keep = [c for c in extra if c in df.columns]
    return df.select(F.col(id_col).cast("string").alias("video_id"),
                     F.col(vector_col).cast("array<float>").alias("embedding"),
                     F.when(F.col(vector_col).isNotNull(), size).alias("dim"),
                     valid.alias("valid"), *keep)
