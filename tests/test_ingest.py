"""Landed-page parsing and ingest skip reasons on handcrafted rows."""

import json

from perfscore.operators import ingest as ig
from perfscore.sources import pages as pg


def _pages(spark, docs):
    rows = [("c1", i, json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "channel_id string, page_no int, page string")


def test_search_page_flatten_and_best_thumbnail(spark):
    page = {"items": [
        {"id": {"videoId": "a"}, "snippet": {"title": "A", "publishedAt": "2024-01-02T03:04:05Z",
                                            "thumbnails": {"maxres": {"url": ""}, "high": {"url": "h"}}}},
        {"id": {"videoId": "b"}, "snippet": {"title": "B", "publishedAt": "2024-01-02T00:00:00Z",
                                            "thumbnails": {"medium": {"url": "m"}}}},
        {"id": {"videoId": "c"}, "snippet": {"title": "C", "publishedAt": "2024-01-02T00:00:00Z",
                                            "thumbnails": {}}},
    ]}
    rows = {r.video_id: r for r in pg.flatten_search_pages(_pages(spark, [page, {"items": []}])).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].thumbnail_url == "h" and rows["b"].thumbnail_url == "m" and rows["c"].thumbnail_url is None
    assert str(rows["a"].published_at) == "2024-01-02 03:04:05"
    assert [rows[k].pos for k in "abc"] == [0, 1, 2]


def test_playlist_drops_hidden_titles(spark):
    page = {"items": [{"snippet": {"title": t, "publishedAt": "2024-01-01T00:00:00Z",
                                   "resourceId": {"videoId": t[:1]}, "thumbnails": {}}}
                      for t in ("Private video", "Deleted video", "Kept")]}
    assert [r.title for r in pg.flatten_playlist_pages(_pages(spark, [page])).collect()] == ["Kept"]


def test_stats_counters(spark):
    page = {"items": [
        {"id": "a", "statistics": {"viewCount": "10", "likeCount": "2"}, "contentDetails": {"duration": "PT1M"}},
        {"id": "b", "statistics": {"viewCount": "n/a"}, "contentDetails": {}},
    ]}
    rows = {r.video_id: r for r in pg.flatten_stats_pages(_pages(spark, [page])).collect()}
    assert (rows["a"].view_count, rows["a"].like_count, rows["a"].comment_count) == (10, 2, 0)
    assert rows["a"].bad_counter is False and rows["b"].bad_counter is True
    assert rows["b"].view_count == 0 and rows["b"].duration == ""


def test_candidate_reasons_and_audit(spark):
    videos = spark.createDataFrame(
        [(v, c) for v, c in [("ok", "c1"), ("short", "c1"), ("few", "c1"), ("nostats", "c1"),
                             ("bad", "c1"), ("lost", "c9")]], "video_id string, channel_id string")
    stats = spark.createDataFrame(
        [("ok", 6000, 0, 0, "PT2M", False), ("short", 6000, 0, 0, "PT30S", False),
         ("few", 4999, 0, 0, "PT2M", False), ("bad", 0, 0, 0, "PT2M", True),
         ("lost", 9000, 0, 0, "PT2M", False)],
        "video_id string, view_count bigint, like_count bigint, comment_count bigint, duration string, "
        "bad_counter boolean")
    channels = spark.createDataFrame([("c1", "Chan", 10)], "channel_id string, channel_name string, "
                                                           "subscriber_count bigint")
    cand = ig.ingest_candidates(videos, stats, channels)
    reasons = {r.video_id: r.reason for r in cand.collect()}
    assert reasons == {"ok": None, "short": "short", "few": "few views", "nostats": "no statistics",
                       "bad": "bad counter", "lost": "channel not found"}
    assert [r.video_id for r in ig.error_rows(cand).collect()] == ["bad"]
    audit = {r.channel_id: (r.found, r.added, r.dropped) for r in ig.ingest_audit(cand).collect()}
    assert audit == {"c1": (5, 1, 4), "c9": (1, 0, 1)}


def test_repeated_landings_give_one_row_the_last(spark):
    import json

    def page(views, at):
        doc = {"items": [{"id": "a", "statistics": {"viewCount": str(views)}, "contentDetails": {"duration": "PT2M"}}]}
        return json.dumps(doc), at

    pages = spark.createDataFrame([page(5, 1), page(9, 3), page(7, 2)], "page string, landed_at int")
    assert [(r.video_id, r.view_count) for r in pg.flatten_stats_pages(pages).collect()] == [("a", 9)]
    images = spark.createDataFrame([("a", "a.png"), ("a", "a.jpg")], "video_id string, path string")
    videos = spark.createDataFrame([("a", "http://x")], "video_id string, thumbnail_url string")
    assert [r.thumbnail_path for r in ig.attach_thumbnail_path(videos, images).collect()] == ["a.jpg"]


def test_broken_pages_dates_and_subscribers_become_errors(spark):
    good = {"items": [{"id": {"videoId": "a"}, "snippet": {"title": "A", "publishedAt": "yesterday", "thumbnails": {}}}]}
    pages = spark.createDataFrame([("c1", 0, json.dumps(good)), ("c1", 1, json.dumps(good)[:-4]), ("c1", 2, None)],
                                  "channel_id string, page_no int, page string")
    rows = pg.flatten_search_pages(pages).where("video_id is not null").collect()
    assert [(r.video_id, r.published_at, r.bad_date) for r in rows][0] == ("a", None, True)
    errors = pg.broken_pages(pages, pg.SEARCH_PAGE).collect()
    assert sorted((r.page_no, r.error) for r in errors) == [(1, "broken page"), (2, "broken page")]
    channel = {"items": [{"id": "c1", "statistics": {"subscriberCount": "many"}, "snippet": {"title": "C"}}]}
    ch = pg.flatten_channel_pages(spark.createDataFrame([(json.dumps(channel),)], "page string")).first()
    assert ch.subscriber_count is None and ch.bad_subscribers


def test_a_large_cap_keeps_the_first_rows_of_a_large_channel(spark):
    df = spark.range(5000).selectExpr("'c' as channel_id", "id div 50 as page_no", "id % 50 as pos", "id")
    assert sorted(r.id for r in ig.cap_per_group(df, 2000).collect()) == list(range(2000))
    plan = ig.cap_per_group(df, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
