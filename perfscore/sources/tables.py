"""Driver tables: one parquet file per table under an ``sf`` folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; filters and projections push into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str,
                    names: tuple[str, ...] = TABLE_NAMES) -> None:
    """Expose the driver tables as temp views under their own names."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
