"""Driver keys: ingest of landed API pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.operators import ingest as ig
from perfscore.operators.stats import top_k
from perfscore.plans import page_fixtures as pf
from perfscore.plans.common import SQL_PERF, videos_raw
from perfscore.plans.fixtures import AS_OF
from perfscore.plans.registry import key
from perfscore.session import materialize
from perfscore.sources import pages as pg

V = ("f_videos_raw",)

SQL_K = "CAST(video_id AS BIGINT)"
SQL_THUMB = (f"CASE WHEN {SQL_K} % 3 = 2 THEN 'https://img/' || video_id || '/maxres.jpg' "
             f"WHEN {SQL_K} % 5 <> 0 THEN 'https://img/' || video_id || '/hq.jpg' "
             "ELSE 'https://img/' || video_id || '/mq.jpg' END")
SQL_HIDDEN = f"({SQL_K} % 11 = 0 OR {SQL_K} % 13 = 0)"
SQL_SHORT = ("CASE WHEN duration LIKE '%H%' THEN false WHEN duration NOT LIKE '%M%' THEN "
             "coalesce(try_cast(replace(replace(duration, 'PT', ''), 'S', '') AS INT) < 60, false) "
             "ELSE coalesce(try_cast(replace(split_part(duration, 'M', 1), 'PT', '') AS INT) = 0, false) END")
SQL_CH = "CAST(channel_id AS BIGINT)"
SQL_REASON = (f"CASE WHEN {SQL_CH} % 10 = 0 THEN 'channel not found' WHEN {SQL_K} % 9 = 0 THEN 'no statistics' "
              f"WHEN {SQL_K} % 97 = 0 THEN 'bad counter' WHEN {SQL_K} % 101 = 0 THEN 'bad date' "
              f"WHEN {SQL_CH} % 41 = 5 THEN 'bad subscriber count' WHEN {SQL_SHORT} THEN 'short' "
              "WHEN view_count < 5000 THEN 'few views' END")
CAP_TEST = 5        # cap used by the cap_per_channel key


def _search(spark, sf_dir):
    return pg.flatten_search_pages(pf.search_pages(spark, sf_dir))


def _candidates(spark, sf_dir):
    videos = _search(spark, sf_dir)
    stats = pg.flatten_stats_pages(pf.stats_pages(spark, sf_dir))
    channels = pg.flatten_channel_pages(pf.channel_pages(spark, sf_dir))
    return ig.ingest_candidates(videos, stats, channels)


def built_videos(spark, sf_dir):
    return ig.build_videos(_candidates(spark, sf_dir), pf.niche_map(spark, sf_dir),
                           pf.image_files(spark, sf_dir), AS_OF)


# Oracle CTE of the built video table.
BUILT_CTE = f""", cand AS (SELECT v.*, {SQL_REASON} AS reason FROM f_videos_raw v),
built AS (
  SELECT video_id, title, published_at, {SQL_THUMB} AS thumbnail_url, channel_id, view_count,
         CASE WHEN {SQL_K} % 7 = 0 THEN 0 ELSE view_count // 10 END AS like_count,
         view_count // 100 AS comment_count, duration, subscriber_count, channel_name,
         {SQL_PERF} AS performance_score, thumbnail_path,
         CASE WHEN {SQL_CH} % 3 <> 0 THEN niche ELSE 'General' END AS niche
  FROM cand WHERE reason IS NULL)
"""


SQL_DATE = f"CASE WHEN {SQL_K} % 101 <> 0 THEN published_at END AS published_at"


@key("ingest_search_pages", f"SELECT video_id, title, {SQL_DATE}, {SQL_THUMB} AS thumbnail_url, channel_id "
     "FROM f_videos_raw", V)
def q_search(spark, sf_dir):
    return _search(spark, sf_dir).select("video_id", "title", "published_at", "thumbnail_url", "channel_id")


@key("ingest_playlist_pages", f"SELECT video_id, title, {SQL_DATE}, {SQL_THUMB} AS thumbnail_url, channel_id "
     f"FROM f_videos_raw WHERE NOT {SQL_HIDDEN}", V)
def q_playlist(spark, sf_dir):
    rows = pg.flatten_playlist_pages(pf.playlist_pages(spark, sf_dir))
    return rows.select("video_id", "title", "published_at", "thumbnail_url", "channel_id")


@key("parse_stats", f"SELECT video_id, CASE WHEN {SQL_K} % 97 = 0 THEN 0 ELSE view_count END AS view_count, "
     f"CASE WHEN {SQL_K} % 7 = 0 THEN 0 ELSE view_count // 10 END AS like_count, "
     f"view_count // 100 AS comment_count, duration FROM f_videos_raw WHERE {SQL_K} % 9 <> 0", V)
def q_parse_stats(spark, sf_dir):
    s = pg.flatten_stats_pages(pf.stats_pages(spark, sf_dir))
    return s.select("video_id", "view_count", "like_count", "comment_count", "duration")


@key("join_channel", f"SELECT video_id, channel_id, channel_name, CASE WHEN {SQL_CH} % 41 <> 5 THEN subscriber_count END "
     f"AS subscriber_count FROM f_videos_raw WHERE {SQL_CH} % 10 <> 0", V)
def q_join_channel(spark, sf_dir):
    from perfscore.operators.joins import lookup_join
    channels = pg.flatten_channel_pages(pf.channel_pages(spark, sf_dir))
    v = _search(spark, sf_dir).select("video_id", "channel_id")
    return lookup_join(v, channels, "channel_id").select("video_id", "channel_id", "channel_name",
                                                         "subscriber_count")


@key("join_stats", f"SELECT video_id, CASE WHEN {SQL_K} % 97 = 0 THEN 0 ELSE view_count END AS view_count, "
     f"duration FROM f_videos_raw WHERE {SQL_K} % 9 <> 0", V)
def q_join_stats(spark, sf_dir):
    stats = pg.flatten_stats_pages(pf.stats_pages(spark, sf_dir))
    v = _search(spark, sf_dir).select("video_id")
    return v.join(stats, "video_id").select("video_id", "view_count", "duration")


@key("cap_per_channel", "SELECT video_id, channel_id FROM f_videos_raw QUALIFY row_number() OVER "
     f"(PARTITION BY channel_id ORDER BY published_at DESC, video_id) <= {CAP_TEST}", V)
def q_cap(spark, sf_dir):
    v = videos_raw(spark, sf_dir).select("video_id", "channel_id", "published_at")
    capped = ig.cap_per_group(v, CAP_TEST, "channel_id",
                              [F.col("published_at").desc(), F.col("video_id")])
    return capped.select("video_id", "channel_id")


@key("ingest_fallback_union", f"SELECT video_id, channel_id, 'search' AS source FROM f_videos_raw "
     f"WHERE {SQL_CH} % 3 <> 0 UNION ALL SELECT video_id, channel_id, 'playlist' FROM f_videos_raw p "
     f"WHERE NOT {SQL_HIDDEN} AND NOT EXISTS (SELECT 1 FROM f_videos_raw s WHERE s.channel_id = p.channel_id "
     f"AND CAST(s.channel_id AS BIGINT) % 3 <> 0)", V)
def q_fallback(spark, sf_dir):
    search = pg.flatten_search_pages(pf.search_pages(
        spark, sf_dir, F.col("channel_id").cast("bigint") % 3 != 0))
    playlist = pg.flatten_playlist_pages(pf.playlist_pages(spark, sf_dir))
    return ig.prefer_search(search, playlist).select("video_id", "channel_id", "source")


@key("niche_lookup", f"SELECT video_id, CASE WHEN {SQL_CH} % 3 <> 0 THEN niche ELSE 'General' END AS niche "
     "FROM f_videos_raw", V)
def q_niche(spark, sf_dir):
    v = videos_raw(spark, sf_dir).select("video_id", "channel_id")
    return ig.niche_lookup(v, pf.niche_map(spark, sf_dir)).select("video_id", "niche")


@key("videos_build", BUILT_CTE + "SELECT * FROM built", V)
def q_videos_build(spark, sf_dir):
    return built_videos(spark, sf_dir)


@key("resume_anti_union", f"SELECT video_id, channel_id, 'stored' AS origin FROM f_videos_raw WHERE {SQL_CH} % 4 = 0 "
     f"UNION ALL SELECT video_id, channel_id, 'new' FROM f_videos_raw WHERE {SQL_CH} % 4 <> 0", V)
def q_resume(spark, sf_dir):
    v = videos_raw(spark, sf_dir).select("video_id", "channel_id")
    stored = v.where(F.col("channel_id").cast("bigint") % 4 == 0)
    known = materialize(ig.known_filter(stored), "known")  # lies beside the store
    return ig.resume(stored, v, known=known)


PAGE_NO = f"CAST(floor({SQL_K} / 50) AS BIGINT)"


@key("page_errors", f"""
SELECT 'search' AS kind, channel_id, {PAGE_NO} AS page_no, 'broken page' AS error FROM f_videos_raw
WHERE {SQL_CH} % 37 = 1 GROUP BY ALL
UNION ALL SELECT 'search', channel_id, {PAGE_NO}, 'broken page' FROM f_videos_raw
WHERE {SQL_CH} % 37 = 1 AND {SQL_K} % 10 = 4 GROUP BY ALL
UNION ALL SELECT 'playlist', channel_id, {PAGE_NO}, 'broken page' FROM f_videos_raw WHERE {SQL_CH} % 37 = 2 GROUP BY ALL
UNION ALL SELECT 'stats', NULL, {PAGE_NO}, 'broken page' FROM f_videos_raw
WHERE {SQL_K} % 9 <> 0 AND {PAGE_NO} % 5 = 1 GROUP BY ALL
UNION ALL SELECT 'stats', NULL, {PAGE_NO}, 'broken page' FROM f_videos_raw
WHERE {SQL_K} % 9 <> 0 AND {SQL_K} % 10 = 3 AND {PAGE_NO} % 5 = 1 GROUP BY ALL
UNION ALL SELECT 'channel', CAST(c_custkey AS VARCHAR), NULL, 'broken page' FROM customer WHERE c_custkey % 37 = 3
UNION ALL SELECT 'channel', CAST(c_custkey AS VARCHAR), NULL, 'broken page' FROM customer
WHERE c_custkey % 37 = 3 AND c_custkey % 7 = 2""", V)
def q_page_errors(spark, sf_dir):
    """Pages of all four kinds cut off while they were landed: an error row each, and the others parse as ever."""
    number = F.col("channel_id").cast("bigint")
    return pg.page_errors(search=pf.cut_off(pf.search_pages(spark, sf_dir), number % 37 == 1),
                          playlist=pf.cut_off(pf.playlist_pages(spark, sf_dir), number % 37 == 2),
                          stats=pf.cut_off(pf.stats_pages(spark, sf_dir), F.col("page_no") % 5 == 1),
                          channel=pf.cut_off(pf.channel_pages(spark, sf_dir), number % 37 == 3))


@key("error_split", f"SELECT video_id, reason AS error FROM (SELECT video_id, {SQL_REASON} AS reason "
     "FROM f_videos_raw) WHERE reason LIKE 'bad%'", V)
def q_error_split(spark, sf_dir):
    return ig.error_rows(_candidates(spark, sf_dir))


@key("ingest_audit", f"SELECT channel_id, count(*) AS found, count(*) FILTER (WHERE reason IS NULL) AS added, "
     f"count(*) - count(*) FILTER (WHERE reason IS NULL) AS dropped FROM (SELECT channel_id, {SQL_REASON} AS reason "
     "FROM f_videos_raw) GROUP BY channel_id", V)
def q_audit(spark, sf_dir):
    return ig.ingest_audit(_candidates(spark, sf_dir))


@key("run_summary", BUILT_CTE + "SELECT count(*) AS n_videos, count(DISTINCT channel_id) AS n_channels, "
     "count(thumbnail_path) AS n_thumbnails FROM built", V)
def q_run_summary(spark, sf_dir):
    return ig.run_summary(built_videos(spark, sf_dir))


@key("top_performance", BUILT_CTE + "SELECT video_id, channel_name, title, view_count, performance_score "
     "FROM built ORDER BY performance_score DESC, video_id LIMIT 10", V)
def q_top_performance(spark, sf_dir):
    top = top_k(built_videos(spark, sf_dir), "performance_score", 10)
    return top.select("video_id", "channel_name", "title", "view_count", "performance_score")


@key("videos_per_channel", BUILT_CTE + "SELECT channel_name, count(*) AS n_videos FROM built "
     "WHERE channel_name IS NOT NULL GROUP BY channel_name", V)
def q_videos_per_channel(spark, sf_dir):
    return ig.per_group_counts(built_videos(spark, sf_dir), "channel_name")
