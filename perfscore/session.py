"""Session settings and the shared scratch location.

Intermediate tables go under the cluster's shared ``spark.checkpoint.dir``.  Only on
a local master (tests, a laptop), where driver and executors are one process, does an
unset folder become a fresh one under /tmp; on a cluster it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (P25), ANSI errors (P24),
# adaptive execution for runtime broadcast / partition coalescing / skew split.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "perfscore") -> SparkSession:
    """Session for tests and the local bench; on a cluster use the given one."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.default.parallelism", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators assume (safe on a shared session)."""
    for key, value in CORE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="perfscore-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "perfscore", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing
    position-dependent results) and is cheaper than an RDD checkpoint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
