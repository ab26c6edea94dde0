"""Ingest of flattened API rows into the video table.

All look-ups (channels, niche map, stored channel ids) are written once and joined as their
size asks; the only shuffles of video-sized data are on ``video_id`` (a uniformly spread key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfscore.functions.video import (DEFAULT_NICHE, MIN_VIEWS, as_of_literal, is_short,
                                       performance_score)
from perfscore.operators.joins import small_side

# Skip reasons, in the order the checks are made.
NO_CHANNEL = "channel not found"
NO_STATS = "no statistics"
BAD_COUNTER = "bad counter"
BAD_DATE = "bad date"
BAD_SUBSCRIBERS = "bad subscriber count"
SHORT = "short"
FEW_VIEWS = "few views"
ERROR_REASONS = (BAD_COUNTER, BAD_DATE, BAD_SUBSCRIBERS)
#: Above this many rows per group the window alone is no longer limited before the shuffle.
PARTIAL_LIMIT = 1000
SALTS = 64

VIDEO_COLUMNS = ("video_id", "title", "published_at", "thumbnail_url", "channel_id", "view_count",
                 "like_count", "comment_count", "duration", "subscriber_count", "channel_name",
                 "performance_score", "thumbnail_path", "niche")


def prefer_search(search: DataFrame, playlist: DataFrame, key: str = "channel_id") -> DataFrame:
    """Search rows, plus playlist rows of channels that have no search rows."""
    covered = small_side(search.select(key).distinct())
    fallback = playlist.join(covered, key, "left_anti")
    return (search.withColumn("source", F.lit("search"))
            .unionByName(fallback.withColumn("source", F.lit("playlist"))))


def cap_per_group(df: DataFrame, n: int, group: str = "channel_id",
                  order: Sequence[Column] | None = None) -> DataFrame:
    """At most ``n`` rows per group in the given order.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the
    shuffle, so a huge channel sends at most ``n`` rows per map task.  Catalyst does so
    for small ``n`` alone; for larger ones each group is first capped in salted parts, of
    which at most ``SALTS * n`` rows meet in one task.
    """
    order = list(order) if order else [F.col("page_no"), F.col("pos")]
    if n > PARTIAL_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        part = Window.partitionBy(group, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= n).drop("_rn", "_salt")
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def niche_lookup(df: DataFrame, niche_map: DataFrame, key: str = "channel_id",
                 default: str = DEFAULT_NICHE) -> DataFrame:
    """Attach ``niche`` from a (channel → niche) map; unknown channels → default."""
    one = niche_map.groupBy(key).agg(F.max("niche").alias("_niche"))  # a repeated channel must not fan out
    m = small_side(one)
    return (df.join(m, key, "left")
            .withColumn("niche", F.coalesce(F.col("_niche"), F.lit(default))).drop("_niche"))


def ingest_candidates(videos: DataFrame, stats: DataFrame, channels: DataFrame,
                      min_views: int = MIN_VIEWS) -> DataFrame:
    """Every fetched video with its statistics, channel info and a skip reason.

    ``reason`` is NULL for kept rows.  The same frame feeds the video table,
    the per-channel audit and the error table.
    """
    st = stats.withColumn("_has_stats", F.lit(True))
    ch = small_side(channels.withColumn("_has_channel", F.lit(True)))
    rows = videos.join(st, "video_id", "left").join(ch, "channel_id", "left")
    flag = lambda c: F.col(c) if c in rows.columns else F.lit(False)
    reason = (F.when(F.col("_has_channel").isNull(), F.lit(NO_CHANNEL))
              .when(F.col("_has_stats").isNull(), F.lit(NO_STATS))
              .when(F.col("bad_counter"), F.lit(BAD_COUNTER))
              .when(flag("bad_date"), F.lit(BAD_DATE))
              .when(flag("bad_subscribers"), F.lit(BAD_SUBSCRIBERS))
              .when(is_short("duration"), F.lit(SHORT))
              .when(F.col("view_count") < min_views, F.lit(FEW_VIEWS)))
    return rows.withColumn("reason", reason).drop("_has_stats", "_has_channel")


def attach_thumbnail_path(df: DataFrame, images: DataFrame) -> DataFrame:
    """Path of the stored image; NULL without a url or without a file."""
    files = images.groupBy("video_id").agg(F.min("path").alias("_path"))  # one of image.jpg and image.png
    return (df.join(files, "video_id", "left")
            .withColumn("thumbnail_path",
                        F.when(F.col("thumbnail_url").isNotNull(), F.col("_path")))
            .drop("_path"))


def build_videos(candidates: DataFrame, niche_map: DataFrame, images: DataFrame,
                 as_of: str) -> DataFrame:
    """Kept candidates → the video record (score, niche, thumbnail path)."""
    kept = candidates.where(F.col("reason").isNull())
    kept = kept.withColumn("performance_score", performance_score(
        "view_count", "published_at", "subscriber_count", as_of_literal(as_of)))
    kept = niche_lookup(kept, niche_map)
    kept = attach_thumbnail_path(kept, images)
    return kept.select(*VIDEO_COLUMNS)


def ingest_audit(candidates: DataFrame) -> DataFrame:
    """Per channel: videos found, added, dropped."""
    return (candidates.groupBy("channel_id")
            .agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("reason").isNull()).alias("added"))
            .withColumn("dropped", F.col("found") - F.col("added")))


def error_rows(candidates: DataFrame) -> DataFrame:
    """Rows that failed to parse: the error table (the run goes on)."""
    return (candidates.where(F.col("reason").isin(*ERROR_REASONS))
            .select("video_id", F.col("reason").alias("error")))


#: Bits of a store's filter of known keys: 2^23 bits are at most 131,072 rows (about 1.6 MB).
FILTER_BITS = 1 << 23


def _bits(key: str, bits: int) -> list[tuple[Column, Column]]:
    """The two places of a key in the filter: word, and bit within the word."""
    slots = [F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(bits)) for seed in (1, 2)]
    return [(F.shiftright(s, 6), s.bitwiseAND(F.lit(63)).cast("int")) for s in slots]


def known_filter(rows: DataFrame, key: str = "channel_id", bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the keys: ``word, bits``, ``bits`` / 64 rows at most however many keys there are.

    Kept beside each stored file; filters of several files are merged by ``merge_filters``.
    """
    slots = F.array(*[F.struct(word.alias("word"), at.alias("at")) for word, at in _bits(key, bits)])
    spread = rows.where(F.col(key).isNotNull()).select(F.inline(slots))
    return spread.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))


def merge_filters(filters: DataFrame) -> DataFrame:
    """One filter of several of the same size."""
    return filters.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_known(fresh: DataFrame, known: DataFrame, key: str = "channel_id", bits: int = FILTER_BITS) -> DataFrame:
    """Add ``_maybe``: false for rows whose key is surely not in the filter (no shuffle: the filter is bounded)."""
    out, hits = fresh, []
    for n, (word, at) in enumerate(_bits(key, bits)):
        side = F.broadcast(known.select(F.col("word").alias(f"_w{n}"), F.col("bits").alias(f"_b{n}")))
        out = out.withColumns({f"_word{n}": word, f"_at{n}": at}).join(side, F.col(f"_word{n}") == F.col(f"_w{n}"), "left")
        hits.append(F.expr(f"coalesce((shiftrightunsigned(_b{n}, _at{n}) & 1) = 1, false)"))
    out = out.withColumn("_maybe", hits[0] & hits[1])
    return out.drop(*[f"{c}{n}" for n in (0, 1) for c in ("_w", "_b", "_word", "_at")])


def resume(stored: DataFrame, fresh: DataFrame, key: str = "channel_id", known: DataFrame | None = None,
           bits: int = FILTER_BITS) -> DataFrame:
    """Keep stored rows; append fresh rows of channels not stored yet.

    With the store's filter (``known_filter``) rows of surely new channels skip the comparison with the
    store; only rows that may be known meet it.
    """
    done = small_side(stored.select(key).distinct())
    if known is None:
        todo = fresh.join(done, key, "left_anti")
    else:
        marked = maybe_known(fresh, known, key, bits)
        todo = marked.where(~F.col("_maybe")).unionByName(marked.where("_maybe").join(done, key, "left_anti")).drop("_maybe")
    return (stored.withColumn("origin", F.lit("stored"))
            .unionByName(todo.withColumn("origin", F.lit("new"))))


def run_summary(videos: DataFrame) -> DataFrame:
    return videos.agg(F.count(F.lit(1)).alias("n_videos"),
                      F.count_distinct("channel_id").alias("n_channels"),
                      F.count("thumbnail_path").alias("n_thumbnails"))


def per_group_counts(videos: DataFrame, group: str = "channel_name") -> DataFrame:
    return (videos.where(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(F.lit(1)).alias("n_videos")).orderBy(F.desc("n_videos"), group))
