"""A keyed table that rewrites only what changed.

Rows lie in buckets by a hash of their key, ``rows/version=<n>/bucket=<b>``.  A batch reads and
rewrites the buckets of its keys alone, under its own version; all others stay where they
are.  ``manifest/version=<n>`` names the newest version of each bucket and is written last, so
a batch counts once its manifest is committed.  A retried batch starts again from the
manifest before it and overwrites its own folders.

Of the versions of a key the greatest wins by ``order`` (event time first, then the batch,
then the place in the batch), whatever order they arrive in; a null counts as the
smallest.  A deletion is a version too: it is kept, so that an older version that arrives later
does not bring the row back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.sources import folders
from perfscore.session import materialize

#: Rows that one task merges; a larger bucket is merged by several, each with a slice of its keys.
ROWS_PER_TASK = 250_000

BATCH = "_batch"
DELETED = "_deleted"


class KeyedTable:
    """One row per key under ``path``; choose ``buckets`` so that a bucket is about a task's work."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str] = (), buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        lead = list(order)
        self.order = lead if BATCH in lead else [*lead[:1], BATCH, *lead[1:]]

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """Newest version of each bucket, as of the last committed batch (before the given one)."""
        done = [int(v) for v in folders.values(self.spark, f"{self.path}/manifest", "version")]
        done = [v for v in done if before is None or v < before]
        if not done:
            return {}
        rows = self.spark.read.schema("bucket int, version long").json(f"{self.path}/manifest/version={max(done)}")
        return {r.bucket: r.version for r in rows.collect()}  # one row per bucket

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _stored(self, manifest: dict[int, int], only: set[int] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/rows/version={v}/bucket={b}" for b, v in sorted(manifest.items())
                 if only is None or b in only]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(*paths).drop("version")

    def _sliced(self, rows: DataFrame, n_rows: int, n_buckets: int) -> DataFrame:
        """Rows dealt by key over as many tasks as their number asks for; a task meets a few buckets only."""
        tasks = max(n_buckets, math.ceil(n_rows / ROWS_PER_TASK))
        per_bucket = math.ceil(2 * tasks / n_buckets)  # finer than tasks, so that tasks come out even
        sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(F.lit(1), F.col(self.key)), F.lit(per_bucket)).cast("int"))
        return sliced.repartition(tasks, "bucket", "_slice")

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (self.key, "bucket", "_slice", *self.order)]
        lead = [c for c in ("bucket", "_slice") if c in rows.columns]
        version = F.struct(*[F.col(c) for c in self.order])
        best = F.max(F.struct(version.alias("v"), F.struct(*rest).alias("r")))
        return rows.groupBy(*lead, self.key).agg(best.alias("_best")).select(
            "bucket", self.key, "_best.v.*", "_best.r.*")

    def merge(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """Merge a batch's rows (with a boolean ``_deleted``, if any is to go); the rows of its
        keys as stored now, or None if the batch is empty."""
        if DELETED not in batch.columns:
            batch = batch.withColumn(DELETED, F.lit(False))
        if BATCH not in batch.columns:
            batch = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        new = materialize(self._bucket(batch), "batch")
        counts = {r["bucket"]: r["count"] for r in new.groupBy("bucket").count().collect()}  # at most all buckets
        touched = set(counts)
        if not touched:
            return None
        before = self.manifest(batch_id)
        old = self._stored(before, touched)
        n_rows = sum(counts.values()) + (0 if old is None else old.count())
        rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
        rows = self._newest(self._sliced(rows, n_rows, len(touched)))
        (rows.write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .parquet(f"{self.path}/rows/version={batch_id}"))
        listed = sorted({**before, **dict.fromkeys(touched, batch_id)}.items())
        (self.spark.createDataFrame(listed, "bucket int, version long").coalesce(1)
         .write.mode("overwrite").json(f"{self.path}/manifest/version={batch_id}"))
        return self._newest(new)

    def _visible(self, rows: DataFrame) -> DataFrame:
        return rows.where(~F.col(DELETED)).drop("bucket", DELETED, BATCH)

    def current(self) -> DataFrame | None:
        """All rows that are not deleted (None before the first batch)."""
        rows = self._stored(self.manifest())
        return None if rows is None else self._visible(rows)

    def lookup(self, keys: DataFrame) -> DataFrame | None:
        """The rows of given keys (a column named like the key, no repeats); other buckets are not read."""
        keys = self._bucket(keys.select(self.key))
        wanted = {r.bucket for r in keys.select("bucket").distinct().collect()}
        rows = self._stored(self.manifest(), wanted)
        return None if rows is None else self._visible(rows).join(keys.select(self.key), self.key, "left_semi")

    def vacuum(self) -> int:
        """Delete bucket folders that the newest manifest does not name; how many went."""
        held = {(b, v) for b, v in self.manifest().items()}
        gone = 0
        for v in folders.values(self.spark, f"{self.path}/rows", "version", committed=False):
            base = f"{self.path}/rows/version={v}"
            for b in folders.values(self.spark, base, "bucket", committed=False):
                if (int(b), int(v)) not in held:
                    folders.remove(self.spark, f"{base}/bucket={b}")
                    gone += 1
        return gone
