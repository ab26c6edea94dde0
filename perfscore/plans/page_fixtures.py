"""Landed API pages built from the fixture views with ``to_json``.

Pages hold at most 50 items (the API page size), keyed by
``(channel_id, page_no)`` with ``page_no = video number DIV 50``, so no page
grows with a hot channel.  Items are ordered inside a page by video number.
The variations below (empty thumbnail sizes, hidden titles, missing or
unparsable counters, unknown channels) exercise every ingest rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.plans.common import videos_raw
from perfscore.sources.tables import read_table

PAGE_SIZE = 50


def _okey():
    return F.col("video_id").cast("bigint")


def _thumbnails():
    vid = F.col("video_id")
    url = lambda kind: F.struct(F.concat(F.lit("https://img/"), vid, F.lit(f"/{kind}.jpg")).alias("url"))
    k = _okey()
    return F.struct(
        F.when(k % 3 == 0, F.struct(F.lit("").alias("url"))).when(k % 3 == 2, url("maxres")).alias("maxres"),
        F.when(k % 5 != 0, url("hq")).alias("high"),
        url("mq").alias("medium"))


def _published():
    """The date as landed; one in 101 is no date."""
    return F.when(_okey() % 101 == 0, F.lit("sometime")).otherwise(
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def _pages(items: DataFrame, keys) -> DataFrame:
    """Group (okey, item) rows into JSON pages of at most PAGE_SIZE items.

    Rows are hash-partitioned on the page key first: a partial ``collect_list``
    does not shrink the data, so this moves item packing off the scan task
    without adding a shuffle (the grouping reuses the partitioning).
    """
    grouped = (items.withColumn("page_no", F.floor(F.col("_k") / PAGE_SIZE))
               .repartition(*keys, "page_no")
               .groupBy(*keys, "page_no")
               .agg(F.sort_array(F.collect_list(F.struct("_k", "item"))).alias("_items")))
    return grouped.select(*keys, "page_no", F.to_json(F.struct(
        F.transform("_items", lambda x: x["item"]).alias("items"))).alias("page"))


def search_pages(spark: SparkSession, sf_dir: str, channel_cond=None) -> DataFrame:
    v = videos_raw(spark, sf_dir)
    if channel_cond is not None:
        v = v.where(channel_cond)
    items = v.select("channel_id", _okey().alias("_k"), F.struct(
        F.struct(F.col("video_id").alias("videoId")).alias("id"),
        F.struct(F.col("title").alias("title"), _published().alias("publishedAt"),
                 _thumbnails().alias("thumbnails")).alias("snippet")).alias("item"))
    earlier = items.where(F.col("_k") % 10 == 4).withColumn(
        "item", F.col("item").withField("snippet.title", F.lit("earlier title")))
    return (_pages(items, ["channel_id"]).withColumn("landed_at", F.lit(2))
            .unionByName(_pages(earlier, ["channel_id"]).withColumn("landed_at", F.lit(1))))  # landed again since


def cut_off(pages: DataFrame, cond) -> DataFrame:
    """Pages of which some were cut off while they were landed."""
    return pages.withColumn("page", F.when(cond, F.expr("substr(page, 1, length(page) - 3)")).otherwise(F.col("page")))


def playlist_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = videos_raw(spark, sf_dir)
    k = _okey()
    title = (F.when(k % 11 == 0, F.lit("Private video"))
             .when(k % 13 == 0, F.lit("Deleted video")).otherwise(F.col("title")))
    items = v.select("channel_id", k.alias("_k"), F.struct(F.struct(
        title.alias("title"), _published().alias("publishedAt"),
        F.struct(F.col("video_id").alias("videoId")).alias("resourceId"),
        _thumbnails().alias("thumbnails")).alias("snippet")).alias("item"))
    return _pages(items, ["channel_id"])


def stats_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = videos_raw(spark, sf_dir)
    k = _okey()
    vc = F.col("view_count")
    items = v.where(k % 9 != 0).select(k.alias("_k"), F.struct(
        F.col("video_id").alias("id"),
        F.struct(F.when(k % 97 == 0, F.lit("n/a")).otherwise(vc.cast("string")).alias("viewCount"),
                 F.when(k % 7 != 0, F.floor(vc / 10).cast("string")).alias("likeCount"),
                 F.floor(vc / 100).cast("string").alias("commentCount")).alias("statistics"),
        F.struct(F.col("duration").alias("duration")).alias("contentDetails")).alias("item"))
    earlier = v.where((k % 9 != 0) & (k % 10 == 3)).select(k.alias("_k"), F.struct(
        F.col("video_id").alias("id"),
        F.struct(F.lit("1").alias("viewCount"), F.lit("1").alias("likeCount"), F.lit("1").alias("commentCount"))
        .alias("statistics"),
        F.struct(F.lit("PT1S").alias("duration")).alias("contentDetails")).alias("item"))
    return (_pages(items, []).withColumn("landed_at", F.lit(2))
            .unionByName(_pages(earlier, []).withColumn("landed_at", F.lit(1))))  # landed again since


def channel_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.when(F.col("c_custkey") % 41 == 5, F.lit("many"))
                 .when(F.col("c_acctbal") >= 0, F.floor("c_acctbal").cast("string"))
                 .alias("subscriberCount")).alias("statistics"),
        F.struct(F.col("c_name").alias("title")).alias("snippet"))
    items = F.when(F.col("c_custkey") % 10 != 0, F.array(item)).otherwise(F.array().cast(
        "array<struct<id:string,statistics:struct<subscriberCount:string>,snippet:struct<title:string>>>"))
    pages = c.select(F.col("c_custkey").cast("string").alias("channel_id"),
                     F.to_json(F.struct(items.alias("items"))).alias("page"), F.lit(1).alias("landed_at"))
    return pages.unionByName(pages.where(F.col("channel_id").cast("bigint") % 7 == 2))  # some channels landed twice


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for a scanned image folder: the videos whose file exists."""
    v = videos_raw(spark, sf_dir)
    return v.where(F.col("thumbnail_path").isNotNull()).select("video_id", F.col("thumbnail_path").alias("path"))


def niche_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known channel niches: channels whose number is not a multiple of 3."""
    v = videos_raw(spark, sf_dir)
    return v.where(F.col("channel_id").cast("bigint") % 3 != 0).select("channel_id", "niche").distinct()


def land(pages: DataFrame, folder: str) -> None:
    """Add the files of one landing to a folder, as many as tasks write."""
    pages.write.mode("append").parquet(folder)


__all__ = ["cut_off", "land", "search_pages", "playlist_pages", "stats_pages", "channel_pages", "image_files", "niche_map"]
