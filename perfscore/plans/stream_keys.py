"""Driver keys: incremental refresh.

T1: ``stream_ingest`` (landed files of orders → keyed state with versions and
deletions → video table), ``stream_pages`` (landed pages whose parts come late) and
``stream_promote`` (file stream of events → additive run partials → promotion gate).  T2:
``zscore_incremental`` (mergeable moments over hash batches), ``zscore_changed`` (values
taken back) and ``zscore_stream`` (stateful streaming group aggregate).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions.video import MIN_VIEWS, as_of_literal, is_short, performance_score
from perfscore.operators.promote import promote_gate
from perfscore.plans import page_fixtures as pf
from perfscore.plans.common import SQL_PERF, enriched_perf, scored_cte
from perfscore.plans.feature_keys import PROMOTE_SQL
from perfscore.plans.fixtures import AS_OF, videos_from
from perfscore.plans.ingest_keys import BUILT_CTE, SQL_SHORT
from perfscore.plans.page_fixtures import land
from perfscore.plans.registry import key
from perfscore.session import apply_core_conf, materialize, scratch_path
from perfscore.sources.tables import read_table
from perfscore.streaming.keyed import DELETED, KeyedTable
from perfscore.streaming.landed import PAGE_SCHEMA, LandedIngest
from perfscore.streaming.refresh import GroupMoments, each_batch, file_stream, read_summed, run_available

E = ("f_enriched",)
N_BATCHES = 4


def _videos_from_batch(batch, sf_dir):
    """One micro-batch of landed order rows → kept, scored video rows."""
    raw = videos_from(batch, read_table(batch.sparkSession, sf_dir, "customer"))
    kept = raw.where(~is_short("duration") & (F.col("view_count") >= MIN_VIEWS))
    return kept.withColumn("performance_score", performance_score(
        "view_count", "published_at", "subscriber_count", as_of_literal(AS_OF)))


def land_and_run(landings, folder, schema, sink, checkpoint):
    """Land one set of files after another; the stream takes each up where it left off, as a batch of its own."""
    for rows in landings:
        land(rows, folder)
        each_batch(file_stream(rows.sparkSession, folder, "*.parquet", schema), sink, checkpoint)


@key("stream_ingest", "SELECT video_id, channel_id, channel_name, published_at, view_count, duration, "
     f"subscriber_count, {SQL_PERF} AS performance_score, niche FROM f_videos_raw "
     f"WHERE NOT ({SQL_SHORT}) AND view_count >= {MIN_VIEWS}", ("f_videos_raw",))
def q_stream_ingest(spark, sf_dir):
    """Three landings of order rows → bucketed keyed state → kept, scored videos.

    Some orders have two versions in the first landing, some are corrected by the second, some
    have a stale version that arrives last, and rows of the first are deleted by the third.
    """
    apply_core_conf(spark)
    orders = read_table(spark, sf_dir, "orders")
    number, folder = F.col("o_orderkey"), scratch_path(spark, "landing")

    def version(rows, landed_at, stale=False, deleted=False):
        out = rows.withColumns({"landed_at": F.lit(landed_at), DELETED: F.lit(deleted)})
        return out.withColumn("o_totalprice", F.col("o_totalprice") * 0 + 999999) if stale else out

    extra = orders.where(number % 6 == 1).withColumn("o_orderkey", -number - 1)
    landings = (version(orders.where(number % 3 != 0), 2).unionByName(version(orders.where(number % 5 == 0), 1, stale=True))
                .unionByName(version(extra, 1)),
                version(orders.where((number % 3 == 0) | (number % 5 == 0)), 3),
                version(orders.where(number % 4 == 1), 0, stale=True).unionByName(version(extra, 2, deleted=True)))
    state = KeyedTable(spark, scratch_path(spark, "videos_state"), "o_orderkey", ("landed_at",), buckets=16)
    land_and_run(landings, folder, landings[0].schema, state.merge, scratch_path(spark, "videos_state_ckpt"))
    return _videos_from_batch(state.current().drop("landed_at"), sf_dir).select(
        "video_id", "channel_id", "channel_name", "published_at", "view_count", "duration",
        "subscriber_count", "performance_score", "niche")


@key("stream_pages", BUILT_CTE + "SELECT * FROM built", ("f_videos_raw",))
def q_stream_pages(spark, sf_dir):
    """Four landings of pages: videos, half of the channels, statistics, then stale versions and the other channels.

    Statistics land two batches after their videos, and half of the channels three.
    """
    apply_core_conf(spark)
    folder = scratch_path(spark, "landed_pages")

    def of(kind, pages):
        columns = [c if c in pages.columns else F.lit(None).alias(c) for c in ("channel_id", "page_no", "page", "landed_at")]
        return pages.select(F.lit(kind).alias("kind"), *columns).select(
            "kind", F.col("channel_id").cast("string"), F.col("page_no").cast("long"), "page", F.col("landed_at").cast("long"))

    search, stats = of("search", pf.search_pages(spark, sf_dir)), of("stats", pf.stats_pages(spark, sf_dir))
    channels = of("channel", pf.channel_pages(spark, sf_dir))
    early = F.col("channel_id").cast("bigint") % 2 == 0
    landings = (search.where("landed_at = 2"), channels.where(early), stats.where("landed_at = 2"),
                search.where("landed_at = 1").unionByName(stats.where("landed_at = 1")).unionByName(channels.where(~early)))
    ingest = LandedIngest(spark, scratch_path(spark, "pages_state"), buckets=16)
    land_and_run(landings, folder, PAGE_SCHEMA, ingest.process, scratch_path(spark, "pages_ckpt"))
    return ingest.videos(pf.niche_map(spark, sf_dir), pf.image_files(spark, sf_dir), AS_OF)


@key("zscore_incremental", f", {scored_cte('niche')} SELECT video_id, round(perf_norm, 6) AS z FROM scored", E)
def q_zscore_incremental(spark, sf_dir):
    """Four hash batches merged into running moments; z equals the one-pass value."""
    df = materialize(enriched_perf(spark, sf_dir).select("video_id", "niche", "performance_score"), "rows")
    part = F.pmod(F.xxhash64("video_id"), F.lit(N_BATCHES))
    moments = GroupMoments(spark, "performance_score", ["niche"], "niche_moments")
    for b in range(N_BATCHES):
        moments.update(df.where(part == b))
    return moments.zscore(df).select("video_id", F.round("z", 6).alias("z"))


@key("zscore_changed", f", {scored_cte('niche')} SELECT video_id, round(perf_norm, 6) AS z FROM scored", E)
def q_zscore_changed(spark, sf_dir):
    """Moments of rows that change afterwards: old values are taken back, removed rows go, z equals one pass.

    One niche starts with values a million times too large, so that taking them back cancels
    and the group is counted anew.
    """
    df = materialize(enriched_perf(spark, sf_dir).select("video_id", "niche", "performance_score"), "rows")
    number, value = F.col("video_id").cast("bigint"), F.col("performance_score")
    wrong = (number % 5 == 0) | (F.col("niche") == "BUILDING")
    old = df.where(wrong).withColumn("performance_score", F.when(F.col("niche") == "BUILDING", value * 1e6 + 1e9).otherwise(value * 3 + 1))
    extra = df.where(number % 7 == 0).withColumn("video_id", F.concat(F.lit("gone"), "video_id"))
    moments = GroupMoments(spark, "performance_score", ["niche"], "changed_moments")
    moments.update(old.unionByName(df.where(~wrong)).unionByName(extra))
    moments.change(old.unionByName(extra), df.where(wrong), df)
    return moments.zscore(df).select("video_id", F.round("z", 6).alias("z"))


def _run_partials(batch, batch_id):
    """One micro-batch of events → additive partials per (segment, day)."""
    return (batch.groupBy(F.col("event_type").alias("segment"), F.to_date("ts").alias("run_day"))
            .agg(F.sum("value").alias("value_sum"), F.count("value").alias("value_n")))


@key("stream_promote", PROMOTE_SQL)
def q_stream_promote(spark, sf_dir):
    """New performance events as a file stream → run metrics → promotion gate.

    Each micro-batch writes partial sums and counts per (segment, day); the
    current run table adds them up, so batches can arrive in any split.
    """
    apply_core_conf(spark)
    schema = read_table(spark, sf_dir, "events").schema
    stream = file_stream(spark, sf_dir, "events.parquet", schema)
    target = scratch_path(spark, "runs_stream")
    run_available(stream, _run_partials, target, scratch_path(spark, "runs_stream_ckpt"))
    runs = read_summed(spark, target, ["segment", "run_day"], ["value_sum", "value_n"]).select(
        "segment", "run_day", (F.col("value_sum") / F.col("value_n") / 100).alias("metric"))
    out = promote_gate(runs)
    return out.select("segment", "run_day", F.round("metric", 6).alias("metric"), "promoted",
                      F.round("champion", 6).alias("champion"), "version")


@key("zscore_stream", f", {scored_cte('niche')} SELECT video_id, round(perf_norm, 6) AS z FROM scored", E)
def q_zscore_stream(spark, sf_dir):
    """T2 as a stateful streaming aggregate.

    Orders arrive as a file stream and are joined with the static channel and
    label tables (stream-static joins).  ``groupBy(niche)`` keeps count, mean
    and sample deviation per group in the state store (state size = number of
    groups), written in complete mode each trigger.  The z-scores of the rows
    then use that table through the checked broadcast join.
    """
    from perfscore.functions.stats import zscore
    from perfscore.operators.joins import small_side
    from perfscore.plans.fixtures import fixture

    apply_core_conf(spark)
    labels = fixture(spark, sf_dir, "f_labels").select(F.col("video_id").alias("image_id"))
    n_images = labels.count()
    orders = file_stream(spark, sf_dir, "orders.parquet", read_table(spark, sf_dir, "orders").schema)
    rows = videos_from(orders, read_table(spark, sf_dir, "customer"))
    number = F.col("video_id").cast("bigint")
    rows = rows.withColumn("image_id", F.when(number % 5 > 0, (number % n_images).cast("string")))
    rows = rows.join(labels, "image_id")
    rows = rows.withColumn("performance_score", performance_score(
        "view_count", "published_at", "subscriber_count", as_of_literal(AS_OF)))
    stats = (rows.where(F.col("niche").isNotNull()).groupBy("niche")
             .agg(F.count("performance_score").alias("n"), F.avg("performance_score").alias("_mean"),
                  F.stddev_samp("performance_score").alias("_std")))
    target = scratch_path(spark, "niche_stats_stream")

    def write_state(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")  # a version per trigger

    q = (stats.writeStream.outputMode("complete").foreachBatch(write_state)
         .option("checkpointLocation", scratch_path(spark, "niche_stats_ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    versions = spark.read.parquet(target)
    newest = versions.select(F.max("batch_id")).scalar()
    table = small_side(versions.where(F.col("batch_id") == newest).drop("n", "batch_id"))
    df = enriched_perf(spark, sf_dir).select("video_id", "niche", "performance_score")
    out = df.join(table, "niche", "left").withColumn("z", zscore("performance_score", "_mean", "_std"))
    return out.select("video_id", F.round("z", 6).alias("z"))
