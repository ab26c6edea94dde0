"""Model promotion gate over a runs table.

A new run is promoted only when its metric beats the current champion by
more than ``margin`` (strictly); the first champion is 0.  A promoted run is greater than all
runs before it, as these are at most the champion plus the margin.  So

1. running maxima within blocks of days, and over the blocks before, leave the *records*: runs
   that beat every earlier one (nothing else can be promoted);
2. a scan over each segment's sorted records keeps one number, the champion;
3. champions only grow, so the champion after a run is a running maximum again.

No task holds a segment's runs as a list, and only records meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfscore.session import materialize

PROMOTION_MARGIN = 0.005   # fixed value: required improvement of the metric
VERSION_FORMAT = "yyyyMMdd"


def runs_from_events(events: DataFrame, segment: str = "event_type", ts: str = "ts",
                     value: str = "value") -> DataFrame:
    """One run per segment and day; metric = mean value / 100."""
    return (events.groupBy(F.col(segment).alias("segment"), F.to_date(ts).alias("run_day"))
            .agg((F.avg(value) / 100).alias("metric")))


def _before(df: DataFrame, value: Column, name: str, inclusive: bool = False) -> DataFrame:
    """Add the greatest ``value`` of the segment's earlier runs (null: none), blocks apart.

    Of like runs those with a value come first.
    """
    order = [F.col("run_day"), F.col("metric").asc_nulls_first(), value.isNull()]
    own = Window.partitionBy("segment", "_block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    blocks = df.groupBy("segment", "_block").agg(F.max(value).alias("_most"))
    earlier = Window.partitionBy("segment").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(F.col("segment").alias("_s"), F.col("_block").alias("_b"), F.max("_most").over(earlier).alias("_carried"))
    joined = df.join(carried, df["segment"].eqNullSafe(carried["_s"]) & df["_block"].eqNullSafe(carried["_b"])).drop("_s", "_b")
    return joined.withColumn(name, F.greatest(F.max(value).over(own), F.col("_carried"))).drop("_carried")


def _promotions(records: DataFrame, margin: float, initial: float) -> DataFrame:
    """The records that beat the champion of their time: one number per segment is remembered."""
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        segment, champion = object(), initial
        for b in batches:
            kept = []
            for k, (s, m) in enumerate(zip(b.column("segment").to_pylist(), b.column("metric").to_pylist())):
                if s != segment:
                    segment, champion = s, initial
                if m > champion + margin:
                    champion = m
                    kept.append(k)
            yield b.take(pa.array(kept, pa.int64()))

    rows = records.select("segment", "run_day", "metric").repartition("segment").sortWithinPartitions(
        "segment", "run_day", "metric")
    return rows.mapInArrow(scan, rows.schema)


def promote_gate(runs: DataFrame, margin: float = PROMOTION_MARGIN, initial: float = 0.0,
                 block_days: int = 1024) -> DataFrame:
    """Per run: promoted flag (null for a run without a metric), champion metric after the run, version tag."""
    runs = runs.select("segment", "run_day", F.col("metric").cast("double").alias("metric"))
    runs = runs.withColumn("_block", F.floor(F.unix_date("run_day") / block_days))
    marked = _before(runs, F.col("metric"), "_most")
    record = F.coalesce(F.col("metric") > F.greatest(F.coalesce("_most", F.lit(initial)), F.lit(initial)), F.lit(False))
    marked = materialize(marked.withColumn("_record", record).drop("_most"), "runs")
    won = _promotions(marked.where("_record"), margin, initial).withColumn("_won", F.lit(True))
    won = won.select(F.col("segment").alias("_s"), F.col("run_day").alias("_d"), F.col("metric").alias("_m"), "_won")
    joined = marked.join(won, marked["_record"] & marked["segment"].eqNullSafe(won["_s"])
                         & marked["run_day"].eqNullSafe(won["_d"]) & (marked["metric"] == won["_m"]), "left")
    joined = joined.withColumn("promoted", F.when(F.col("metric").isNotNull(), F.coalesce("_won", F.lit(False))))
    joined = joined.drop("_s", "_d", "_m", "_won", "_record")
    out = _before(materialize(joined, "promoted"), F.when(F.col("promoted"), F.col("metric")), "_champion", inclusive=True)
    return out.select("segment", "run_day", "metric", "promoted",
                      F.coalesce("_champion", F.lit(initial).cast("double")).alias("champion"),
                      F.when(F.col("promoted"), F.date_format("run_day", VERSION_FORMAT)).alias("version"))
