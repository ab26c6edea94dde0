"""Incremental refresh.

T1: a file stream feeds ``foreachBatch``; each micro-batch is transformed with
the ordinary batch operators and written to ``target/batches/batch_id=<id>``.
A retried batch overwrites its own folder, so the sink is idempotent; readers
merge on the key and keep the row of the latest batch (merge on read).
``compact`` writes the merged state as ``target/base/upto=<id>``; readers then
take the newest base plus only the batches after it, so reads stay bounded.

Keyed state with event-time versions and deletions, rewritten bucket by bucket, is in
``streaming.keyed``; ``streaming.landed`` ingests landed pages on top of it.

T2: per-group running statistics ``(n, mean, M2)`` merged batch by batch with
the pairwise update (no sums of squares, which cancel), so z-scores after any
number of batches equal a one-pass computation over all rows.  Changed and removed
rows are taken back by the inverse update.  State is
written to the shared checkpoint folder after each update, which cuts lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.functions.stats import Z_EPS, zscore
from perfscore.operators.joins import small_side
from perfscore.session import materialize, scratch_path

BatchFn = Callable[[DataFrame, int], DataFrame]


def file_stream(spark: SparkSession, folder: str, glob: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the files of ``folder`` matching ``glob`` (explicit schema).

    ``max_files_per_trigger`` bounds the size of one micro-batch when a large
    backlog has landed; by default each trigger takes everything available.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def run_available(stream: DataFrame, transform: BatchFn, target: str, checkpoint: str,
                  on_batch: Callable[[DataFrame, int], None] | None = None) -> None:
    """Process everything available now into a folder per batch, then stop (restartable via the checkpoint)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id)
        out.write.mode("overwrite").parquet(f"{target}/batches/batch_id={batch_id}")
        if on_batch is not None:
            on_batch(out, batch_id)

    each_batch(stream, sink, checkpoint)


def each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand everything available now to an idempotent ``sink(batch, batch_id)``, batch by batch."""
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _latest_rows(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    cols = [c for c in df.columns if c not in (key, "batch_id")]
    # versions that tie on event time and batch: the greatest row wins, in whatever order they came
    best = F.max(F.struct(F.struct(*order, "batch_id").alias("_at"), F.struct(*cols).alias("_row")))
    latest = df.groupBy(key).agg(best.alias("_best")).select(key, "_best._row")
    return latest.select(key, "_row.*")


def read_current(spark: SparkSession, target: str, key: str = "video_id", order: Sequence[str] = ()) -> DataFrame:
    """Latest version of each key: newest compacted base plus the batches after it.

    ``order`` names the columns of a version (event time first) that decide before the batch's
    number does; state that is rewritten bucket by bucket is in ``streaming.keyed``.
    """
    batches = spark.read.parquet(f"{target}/batches")
    base = _read_or_none(spark, f"{target}/base")
    if base is None:
        return _latest_rows(batches, key, order)
    upto = base.select(F.max("upto")).scalar()
    base_rows = base.where(F.col("upto") == upto).withColumnRenamed("upto", "batch_id")
    newer = batches.where(F.col("batch_id") > upto)
    return _latest_rows(base_rows.unionByName(newer), key, order)


def compact(spark: SparkSession, target: str, key: str = "video_id", order: Sequence[str] = ()) -> int:
    """Write the current state as a new base covering all batches so far.

    Idempotent: the base folder is named after the last batch it covers.
    Returns that batch id.
    """
    upto = spark.read.parquet(f"{target}/batches").select(F.max("batch_id")).first()[0]
    read_current(spark, target, key, order).write.mode("overwrite").parquet(f"{target}/base/upto={upto}")
    return int(upto)


def read_summed(spark: SparkSession, target: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Combine additive partial aggregates written by several batches (sum of sums)."""
    df = spark.read.parquet(f"{target}/batches")
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


# ---------------------------------------------------------------------------
# Mergeable group statistics
# ---------------------------------------------------------------------------

def batch_moments(df: DataFrame, value: str, group_cols: Sequence[str]) -> DataFrame:
    """Per group of one batch: n, mean and M2 = Σ(x - mean)²."""
    keyed = df.where(F.col(value).isNotNull())
    for g in group_cols:
        keyed = keyed.where(F.col(g).isNotNull())
    return (keyed.groupBy(*group_cols)
            .agg(F.count(value).cast("double").alias("n"), F.avg(value).alias("mean"),
                 (F.var_pop(value) * F.count(value)).alias("m2")))


def merge_moments(state: DataFrame | None, batch: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Pairwise (Chan et al.) merge of two moment tables by group."""
    if state is None:
        return batch
    a = state.select(*group_cols, F.col("n").alias("na"), F.col("mean").alias("ma"), F.col("m2").alias("qa"))
    b = batch.select(*group_cols, F.col("n").alias("nb"), F.col("mean").alias("mb"), F.col("m2").alias("qb"))
    j = a.join(b, list(group_cols), "full_outer")
    na, nb = F.coalesce("na", F.lit(0.0)), F.coalesce("nb", F.lit(0.0))
    n = na + nb
    delta = F.coalesce(F.col("mb"), F.lit(0.0)) - F.coalesce(F.col("ma"), F.lit(0.0))
    mean = (F.when(F.col("na").isNull(), F.col("mb")).when(F.col("nb").isNull(), F.col("ma"))
            .otherwise(F.col("ma") + delta * nb / n))
    m2 = (F.when(F.col("na").isNull(), F.col("qb")).when(F.col("nb").isNull(), F.col("qa"))
          .otherwise(F.col("qa") + F.col("qb") + delta * delta * na * nb / n))
    return j.select(*group_cols, n.alias("n"), mean.alias("mean"), m2.alias("m2"))


#: A group whose M2 shrinks below this share of what it was has lost digits and is counted anew.
RECOUNT_BELOW = 1e-4


def retract_moments(state: DataFrame, removed: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Moments without the removed rows (the pairwise merge, inverted), and ``doubtful``.

    A group is doubtful when its rows nearly cancel (or more are taken away than it has):
    its moments have to be counted from its rows.  Emptied groups go.
    """
    a = state.select(*group_cols, F.col("n").alias("na"), F.col("mean").alias("ma"), F.col("m2").alias("qa"))
    b = removed.select(*group_cols, F.col("n").alias("nb"), F.col("mean").alias("mb"), F.col("m2").alias("qb"))
    j = a.join(b, list(group_cols), "full_outer")
    na, nb = F.coalesce("na", F.lit(0.0)), F.coalesce("nb", F.lit(0.0))
    n = na - nb
    untouched = nb == 0
    mean = F.col("ma") - F.try_divide((F.col("mb") - F.col("ma")) * nb, n)
    delta = F.col("mb") - mean
    m2 = F.col("qa") - F.col("qb") - F.try_divide(delta * delta * n * nb, na)
    j = j.select(*group_cols, n.alias("n"), F.when(untouched, F.col("ma")).otherwise(mean).alias("mean"),
                 F.when(untouched, F.col("qa")).otherwise(m2).alias("m2"), "qa", untouched.alias("_same"))
    kept = ~F.col("_same") & ((F.col("n") < 0) | F.col("m2").isNull() | (F.col("m2") <= RECOUNT_BELOW * F.col("qa")))
    return j.where(F.col("n") != 0).select(*group_cols, "n", "mean", "m2", kept.alias("doubtful"))


class GroupMoments:
    """Running (n, mean, M2) per group, persisted after every update."""

    def __init__(self, spark: SparkSession, value: str, group_cols: Sequence[str], name: str = "moments"):
        self.spark, self.value, self.group_cols = spark, value, list(group_cols)
        self.base = scratch_path(spark, name)
        self.version = 0
        self.state: DataFrame | None = None

    def update(self, batch: DataFrame) -> DataFrame:
        """Add a batch of new rows."""
        return self._store(merge_moments(self.state, batch_moments(batch, self.value, self.group_cols),
                                         self.group_cols))

    def change(self, removed: DataFrame, added: DataFrame, rows: DataFrame) -> DataFrame:
        """Take back rows as they were counted and add others; a changed row is in both.

        ``rows`` holds all rows as they are after the change.  Of these only doubtful groups' are read
        (see ``retract_moments``), which are counted anew.
        """
        if self.state is None:
            raise ValueError("nothing has been counted yet")
        keys = self.group_cols
        left = materialize(retract_moments(self.state, batch_moments(removed, self.value, keys), keys), "retracted")
        doubtful = left.where("doubtful").select(*keys)
        fresh = batch_moments(added, self.value, keys).join(doubtful, keys, "left_anti")
        merged = merge_moments(left.where("NOT doubtful").drop("doubtful"), fresh, keys)
        counted = batch_moments(rows.join(doubtful, keys, "left_semi"), self.value, keys)
        return self._store(merged.unionByName(counted))

    def _store(self, state: DataFrame) -> DataFrame:
        self.version += 1
        path = f"{self.base}/v={self.version}"
        state.write.mode("overwrite").parquet(path)
        self.state = self.spark.read.parquet(path)
        return self.state

    def std_table(self) -> DataFrame:
        """mean and sample std per group (NULL std for a one-row group)."""
        s = self.state
        std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
        return s.select(*self.group_cols, F.col("mean").alias("_mean"), std.alias("_std"))

    def zscore(self, df: DataFrame, out: str = "z", eps: float = Z_EPS) -> DataFrame:
        stats = small_side(self.std_table())
        return (df.join(stats, self.group_cols, "left")
                .withColumn(out, zscore(self.value, "_mean", "_std", eps)).drop("_mean", "_std"))
