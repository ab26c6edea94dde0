"""Landed API pages (JSON strings) flattened into typed rows.

A landed page table has one JSON document per row in column ``page`` plus
the request key (``channel_id``) and the page number ``page_no``.  Pages are
parsed with an explicit schema (no inference), items are exploded with their
position so that page order survives the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfscore.functions.video import HIDDEN_TITLES, best_thumbnail, counter

BROKEN_PAGE = "broken page"

_URL = T.StructType([T.StructField("url", T.StringType())])
THUMBNAILS = T.StructType([T.StructField(s, _URL) for s in ("maxres", "high", "medium", "default")])

SEARCH_PAGE = T.StructType([
    T.StructField("nextPageToken", T.StringType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StructType([T.StructField("videoId", T.StringType())])),
        T.StructField("snippet", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("publishedAt", T.StringType()),
            T.StructField("thumbnails", THUMBNAILS),
        ])),
    ]))),
])

PLAYLIST_PAGE = T.StructType([
    T.StructField("nextPageToken", T.StringType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("snippet", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("publishedAt", T.StringType()),
            T.StructField("resourceId", T.StructType([T.StructField("videoId", T.StringType())])),
            T.StructField("thumbnails", THUMBNAILS),
        ])),
    ]))),
])

STATS_PAGE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("statistics", T.StructType([
            T.StructField("viewCount", T.StringType()),
            T.StructField("likeCount", T.StringType()),
            T.StructField("commentCount", T.StringType()),
        ])),
        T.StructField("contentDetails", T.StructType([T.StructField("duration", T.StringType())])),
    ]))),
])

CHANNEL_PAGE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("statistics", T.StructType([T.StructField("subscriberCount", T.StringType())])),
        T.StructField("snippet", T.StructType([T.StructField("title", T.StringType())])),
    ]))),
])


def parse_iso_utc(col) -> F.Column:
    """ISO-8601 text with ``Z`` → TIMESTAMP_NTZ wall clock in UTC (session zone UTC); unparsable → NULL."""
    return F.try_to_timestamp(col).cast("timestamp_ntz")


def _unparsed(text, parsed) -> F.Column:
    """Whether a value was landed but could not be read."""
    return text.isNotNull() & parsed.isNull()


def broken_pages(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """Pages that are not JSON of the schema: their keys and an error (the run goes on)."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("page", marked, {"columnNameOfCorruptRecord": "_corrupt"})
    keys = [c for c in ("channel_id", "page_no") if c in pages.columns]
    bad = pages.select(*keys, "page", parsed.alias("p")).where(
        F.col("page").isNull() | F.col("p").isNull() | F.col("p._corrupt").isNotNull())
    return bad.select(*keys, F.lit(BROKEN_PAGE).alias("error"))


#: Schema of each kind of page.
PAGE_KINDS = {"search": SEARCH_PAGE, "playlist": PLAYLIST_PAGE, "stats": STATS_PAGE, "channel": CHANNEL_PAGE}


def page_errors(**pages: DataFrame | None) -> DataFrame:
    """Broken pages of all given kinds (``search=``, ``playlist=``, ``stats=``, ``channel=``): kind, keys and error."""
    out = None
    for kind, landed in pages.items():
        if landed is None:
            continue
        bad = broken_pages(landed, PAGE_KINDS[kind])
        for name, sql_type in (("channel_id", "string"), ("page_no", "bigint")):
            if name not in bad.columns:
                bad = bad.withColumn(name, F.lit(None).cast(sql_type))
        bad = bad.select(F.lit(kind).alias("kind"), "channel_id", "page_no", "error")
        out = bad if out is None else out.unionByName(bad)
    return out


def latest_landing(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: the one landed last (``landed_at``); ties go to the greatest row.

    A partial aggregate on the key that the rows are joined on next, so a record that was
    landed again neither fans out nor costs a further shuffle.
    """
    rest = [c for c in rows.columns if c not in (key, "landed_at")]
    at = F.col("landed_at") if "landed_at" in rows.columns else F.lit(0)
    best = F.max(F.struct(at.alias("_at"), F.struct(*rest).alias("_row")))
    return rows.groupBy(key).agg(best.alias("_best")).select(key, "_best._row.*")


def _items(pages: DataFrame, schema: T.StructType, keep=("channel_id", "page_no")) -> DataFrame:
    keep = (*keep, "landed_at")
    cols = [c for c in keep if c in pages.columns]
    parsed = pages.select(*cols, F.from_json("page", schema).alias("p"))
    return parsed.select(*cols, F.posexplode_outer("p.items").alias("pos", "item")).where(
        F.col("item").isNotNull())


def flatten_search_pages(pages: DataFrame) -> DataFrame:
    """Search pages → video_id, title, published_at, thumbnail_url, channel_id: one row per video, the one landed last."""
    return latest_landing(search_rows(pages), "video_id")


def _landed(items: DataFrame) -> list[str]:
    return [c for c in ("landed_at",) if c in items.columns]


def search_rows(pages: DataFrame) -> DataFrame:
    """The items of search pages as they landed (items without a video id are no videos)."""
    it = _items(pages, SEARCH_PAGE).where(F.col("item.id.videoId").isNotNull())
    return it.select(
        F.col("item.id.videoId").alias("video_id"), *_landed(it),
        F.col("item.snippet.title").alias("title"),
        parse_iso_utc(F.col("item.snippet.publishedAt")).alias("published_at"),
        best_thumbnail(F.col("item.snippet.thumbnails")).alias("thumbnail_url"),
        "channel_id", "page_no", "pos",
        _unparsed(F.col("item.snippet.publishedAt"), parse_iso_utc(F.col("item.snippet.publishedAt"))).alias("bad_date"))


def flatten_playlist_pages(pages: DataFrame) -> DataFrame:
    """Playlist pages (id under resourceId): one row per video; private and deleted entries dropped."""
    it = _items(pages, PLAYLIST_PAGE).where(F.col("item.snippet.resourceId.videoId").isNotNull())
    out = it.select(
        F.col("item.snippet.resourceId.videoId").alias("video_id"), *_landed(it),
        F.col("item.snippet.title").alias("title"),
        parse_iso_utc(F.col("item.snippet.publishedAt")).alias("published_at"),
        best_thumbnail(F.col("item.snippet.thumbnails")).alias("thumbnail_url"),
        "channel_id", "page_no", "pos",
        _unparsed(F.col("item.snippet.publishedAt"), parse_iso_utc(F.col("item.snippet.publishedAt"))).alias("bad_date"))
    out = latest_landing(out, "video_id")  # an entry hidden since its last landing is hidden
    return out.where(~F.coalesce(F.col("title").isin(*HIDDEN_TITLES), F.lit(False)))


def flatten_stats_pages(pages: DataFrame) -> DataFrame:
    """Statistics pages → counters as BIGINT (missing/unparsable → 0) + duration.

    ``bad_counter`` marks counters that are present but not numbers, so the
    ingest can route such rows to its error table instead of failing.
    """
    return latest_landing(stats_rows(pages), "video_id")


def stats_rows(pages: DataFrame) -> DataFrame:
    """The items of statistics pages as they landed."""
    it = _items(pages, STATS_PAGE, keep=())
    s = F.col("item.statistics")
    present_bad = None
    for name in ("viewCount", "likeCount", "commentCount"):
        c = s[name].isNotNull() & s[name].try_cast("bigint").isNull()
        present_bad = c if present_bad is None else present_bad | c
    return it.where(F.col("item.id").isNotNull()).select(
        F.col("item.id").alias("video_id"), *_landed(it),
        counter(s["viewCount"]).alias("view_count"),
        counter(s["likeCount"]).alias("like_count"),
        counter(s["commentCount"]).alias("comment_count"),
        F.coalesce(F.col("item.contentDetails.duration"), F.lit("")).alias("duration"),
        present_bad.alias("bad_counter"))


def flatten_channel_pages(pages: DataFrame) -> DataFrame:
    """Channel pages → channel_id, channel_name, subscriber_count (missing → 0, unparsable → NULL)."""
    return latest_landing(channel_rows(pages), "channel_id")


def channel_rows(pages: DataFrame) -> DataFrame:
    """The items of channel pages as they landed."""
    it = _items(pages, CHANNEL_PAGE, keep=())
    count = F.col("item.statistics.subscriberCount")
    bad = _unparsed(count, count.try_cast("bigint"))
    return it.where(F.col("item.id").isNotNull()).select(
        F.col("item.id").alias("channel_id"), *_landed(it),
        F.col("item.snippet.title").alias("channel_name"),
        F.when(~bad, counter(count)).alias("subscriber_count"), bad.alias("bad_subscribers"))
