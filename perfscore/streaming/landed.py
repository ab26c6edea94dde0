"""Incremental ingest of landed pages whose parts arrive in any order (T1 over B1-B14).

A landing holds pages of several kinds (``kind``: search, stats or channel).  Each kind's rows go
to a keyed table of their own; what a batch changes is looked up there and run through
the same operators as the one-shot ingest.  A video whose statistics or channel
has not landed waits in ``pending`` and is joined again by the batch that brings what it lacks; a
channel page that lands anew also rebuilds the channel's other videos.  After any split of the
pages into batches, in any order, ``videos`` equals the one-shot ingest of all pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.operators import ingest as ig
from perfscore.session import materialize
from perfscore.sources import pages as pg
from perfscore.streaming.keyed import DELETED, KeyedTable

PAGE_SCHEMA = "kind string, channel_id string, page_no long, page string, landed_at long"
WAITING = (ig.NO_CHANNEL, ig.NO_STATS)


class LandedIngest:
    """State of the ingest under ``path``: keyed tables of parts, of candidates and of waiting videos."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        def table(name: str, key: str, order=()) -> KeyedTable:
            return KeyedTable(spark, f"{path}/{name}", key, order, buckets)

        self.spark = spark
        self.found = table("found", "video_id", ("landed_at", "page_no", "pos"))
        self.stats = table("stats", "video_id", ("landed_at",))
        self.channels = table("channels", "channel_id", ("landed_at",))
        self.candidates = table("candidates", "video_id")
        self.pending = table("pending", "video_id")

    def process(self, pages: DataFrame, batch_id: int) -> None:
        """One micro-batch of pages; a retried batch gives the same state."""
        def of(kind: str) -> DataFrame:
            return pages.where(F.col("kind") == kind)

        videos = self.found.merge(pg.search_rows(of("search")), batch_id)
        stats = self.stats.merge(pg.stats_rows(of("stats")), batch_id)
        channels = self.channels.merge(pg.channel_rows(of("channel")), batch_id)
        changed = [t.select("video_id") for t in (videos, stats) if t is not None]
        if channels is not None:
            changed += self._of_channels(channels.select("channel_id"), batch_id)
        if not changed:
            return
        ids = materialize(reduce(DataFrame.unionByName, changed).distinct(), "changed")
        found = self.found.lookup(ids)
        if found is None:  # statistics alone, before any video
            return
        none = lambda rows: self.spark.createDataFrame([], rows.schema)
        stored_stats, stored_channels = self.stats.lookup(ids), self.channels.current()
        if stored_stats is None:
            stored_stats = none(pg.stats_rows(of("stats")))
        if stored_channels is None:
            stored_channels = none(pg.channel_rows(of("channel")))
        rows = ig.ingest_candidates(found.drop("landed_at"), stored_stats.drop("landed_at"),
                                    stored_channels.drop("landed_at"))
        rows = materialize(rows, "candidates")
        self.candidates.merge(rows, batch_id)
        waits = F.coalesce(F.col("reason").isin(*WAITING), F.lit(False))
        self._wait(rows.select("video_id", "channel_id", "reason", (~waits).alias(DELETED)), batch_id)

    def _of_channels(self, ids: DataFrame, batch_id: int) -> list[DataFrame]:
        """Videos of the given channels: those that wait for one, and, of channels known before, all."""
        out = []
        waiting = self.pending.current()
        if waiting is not None:
            out.append(waiting.join(ids, "channel_id", "left_semi").select("video_id"))
        stored = self.candidates.current()
        if stored is not None:  # two columns of the table are read
            known = stored.where(~F.coalesce(F.col("reason") == ig.NO_CHANNEL, F.lit(False)))
            out.append(known.select("video_id", "channel_id").join(ids, "channel_id", "left_semi").select("video_id"))
        return out

    def _wait(self, rows: DataFrame, batch_id: int) -> None:
        """Waiting videos are noted; those that no longer wait are taken off, if they were noted."""
        noted = self.pending.lookup(rows.select("video_id"))
        resolved = rows.where(DELETED)
        rows = rows.where(~F.col(DELETED))
        if noted is not None:
            rows = rows.unionByName(resolved.join(noted.select("video_id"), "video_id", "left_semi"))
        self.pending.merge(rows, batch_id)

    def videos(self, niche_map: DataFrame, images: DataFrame, as_of: str) -> DataFrame:
        """The video table of all pages so far."""
        return ig.build_videos(self.candidates.current(), niche_map, images, as_of)
