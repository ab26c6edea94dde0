"""Keyed state, landed pages in any order, retractable moments, committed snapshots."""

import json
import random

import pytest
from pyspark.sql import functions as F

from perfscore.operators import ingest as ig
from perfscore.session import scratch_path
from perfscore.sources import files as fl
from perfscore.sources import folders
from perfscore.sources import pages as pg
from perfscore.streaming.keyed import KeyedTable
from perfscore.streaming.landed import PAGE_SCHEMA, LandedIngest
from perfscore.streaming.refresh import GroupMoments, batch_moments, retract_moments

SCHEMA = "k string, at long, v long, _deleted boolean"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def state(table):
    return {r.k: r.v for r in table.current().collect()}


@pytest.fixture
def table(spark):
    return KeyedTable(spark, scratch_path(spark, "keyed"), "k", ("at",), buckets=8)


def test_newest_version_wins_whatever_its_batch(spark, table):
    table.merge(rows(spark, [("a", 2, 90, False), ("a", 1, 100, False), ("b", 5, 1, False), ("c", 1, 1, False)]), 0)
    assert state(table) == {"a": 90, "b": 1, "c": 1}
    table.merge(rows(spark, [("a", 3, 7, False), ("b", 4, 55, False), ("c", None, 9, False)]), 1)
    assert state(table) == {"a": 7, "b": 1, "c": 1}
    table.merge(rows(spark, [("b", 5, 2, False)]), 2)  # the same event time: the later batch
    assert state(table)["b"] == 2


def test_deleted_rows_stay_away_from_late_versions(spark, table):
    table.merge(rows(spark, [("a", 1, 1, False), ("b", 1, 1, False)]), 0)
    table.merge(rows(spark, [("a", 5, None, True)]), 1)
    table.merge(rows(spark, [("a", 4, 4, False)]), 2)
    assert state(table) == {"b": 1}
    table.merge(rows(spark, [("a", 6, 6, False)]), 3)
    assert state(table) == {"a": 6, "b": 1}


def test_a_batch_reads_and_rewrites_its_buckets_alone(spark, table):
    table.merge(rows(spark, [(f"k{i}", 1, i, False) for i in range(100)]), 0)
    before = table.manifest()
    assert len(before) == 8
    stored, read = table._stored, []
    table._stored = lambda *how: read.append(stored(*how)) or read[-1]
    table.merge(rows(spark, [("k3", 2, -3, False)]), 1)
    (old,) = read
    assert len({f.split("bucket=")[1].split("/")[0] for f in old.inputFiles()}) == 1
    after = table.manifest()
    assert [b for b in after if after[b] != before[b]] == [b for b in after if after[b] == 1] and list(after.values()).count(1) == 1
    found = table.lookup(spark.createDataFrame([("k3",), ("none",)], "k string"))
    assert [(r.k, r.v) for r in found.collect()] == [("k3", -3)]
    assert len(state(table)) == 100


def test_a_retried_batch_changes_nothing_and_an_uncommitted_one_does_not_count(spark, table):
    table.merge(rows(spark, [("a", 1, 1, False)]), 0)
    batch = rows(spark, [("a", 1, 2, False), ("b", 1, 1, False)])
    table.merge(batch, 1)
    first = state(table)
    folders.remove(spark, f"{table.path}/manifest/version=1/_SUCCESS")  # as if the driver was lost before the commit
    assert state(table) == {"a": 1}
    table.merge(batch, 1)
    assert state(table) == first
    assert table.merge(rows(spark, []), 2) is None and state(table) == first


def test_vacuum_deletes_what_no_manifest_names(spark, table):
    for n in range(3):
        table.merge(rows(spark, [("a", n, n, False), (f"b{n}", 1, 1, False)]), n)
    kept = state(table)
    assert table.vacuum() >= 2 and state(table) == kept and table.vacuum() == 0


# -- landed pages ---------------------------------------------------------------------------------

AS_OF = "2024-01-01 00:00:00"


def landed():
    """Pages of two channels: videos, statistics and channels, some landed twice with other contents."""
    def search(channel, at, ids, title="t"):
        items = [{"id": {"videoId": v}, "snippet": {"title": f"{title} {v}", "publishedAt": "2023-05-01T00:00:00Z"}} for v in ids]
        return ("search", channel, 0, json.dumps({"items": items}), at)

    def stats(at, views):
        items = [{"id": v, "statistics": {"viewCount": str(n)}, "contentDetails": {"duration": "PT5M"}} for v, n in views.items()]
        return ("stats", None, 0, json.dumps({"items": items}), at)

    def channel(name, at, subs):
        item = {"id": name, "statistics": {"subscriberCount": str(subs)}, "snippet": {"title": f"name {name}"}}
        return ("channel", name, None, json.dumps({"items": [item]}), at)

    return [search("x", 2, ["a", "b", "c"]), search("x", 1, ["a", "b"], "old"), search("y", 1, ["d", "e"]),
            search("y", 1, ["d", "e"]), stats(3, {"a": 9000, "b": 100, "d": 7000}), stats(1, {"a": 1, "d": 8000, "e": 6000}),
            channel("x", 1, 10), channel("x", 5, 20), channel("y", 1, 5), ("stats", None, 9, "{broken", 7)]


def one_shot(spark, pages):
    df = spark.createDataFrame(pages, PAGE_SCHEMA)
    of = lambda kind: df.where(F.col("kind") == kind)
    cand = ig.ingest_candidates(pg.flatten_search_pages(of("search")), pg.flatten_stats_pages(of("stats")),
                                pg.flatten_channel_pages(of("channel")))
    return cand


def facts(df):
    return sorted((r.video_id, r.title, r.view_count, r.subscriber_count, r.reason) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_order_of_pages_equals_one_shot(spark, seed):
    pages = landed()
    random.Random(seed).shuffle(pages)
    ingest = LandedIngest(spark, scratch_path(spark, "landed"), buckets=2)
    for n, part in enumerate((pages[:3], pages[3:5], pages[5:8], pages[8:])):
        ingest.process(spark.createDataFrame(part, PAGE_SCHEMA), n)
    expected = one_shot(spark, pages)
    assert facts(ingest.candidates.current()) == facts(expected)
    waiting = {r.video_id for r in ingest.pending.current().collect()}
    assert waiting == {r.video_id for r in expected.collect() if r.reason in (ig.NO_CHANNEL, ig.NO_STATS)} == {"c"}


def test_a_video_waits_for_its_parts(spark):
    p = landed()
    ingest = LandedIngest(spark, scratch_path(spark, "landed"), buckets=2)
    ingest.process(spark.createDataFrame([p[2]], PAGE_SCHEMA), 0)
    assert {(r.video_id, r.reason) for r in ingest.pending.current().collect()} == {("d", ig.NO_CHANNEL), ("e", ig.NO_CHANNEL)}
    ingest.process(spark.createDataFrame([p[8]], PAGE_SCHEMA), 1)
    assert {r.reason for r in ingest.pending.current().collect()} == {ig.NO_STATS}
    ingest.process(spark.createDataFrame([p[5]], PAGE_SCHEMA), 2)
    assert ingest.pending.current().count() == 0
    assert {(r.video_id, r.view_count, r.reason) for r in ingest.candidates.current().collect()} == {
        ("d", 8000, None), ("e", 6000, None)}


def test_a_page_landed_twice_gives_each_video_once(spark):
    got = pg.flatten_search_pages(spark.createDataFrame(landed(), PAGE_SCHEMA).where("kind = 'search'")).collect()
    assert sorted((r.video_id, r.title) for r in got) == [("a", "t a"), ("b", "t b"), ("c", "t c"), ("d", "t d"), ("e", "t e")]


def test_broken_pages_of_every_kind(spark):
    broken = spark.createDataFrame([("c1", 4, "{"), ("c2", 5, None)], "channel_id string, page_no long, page string")
    got = pg.page_errors(search=broken, playlist=None, stats=broken.drop("channel_id"), channel=broken.drop("page_no"))
    assert sorted((r.kind, r.channel_id or "", r.page_no or 0) for r in got.collect()) == [
        ("channel", "c1", 0), ("channel", "c2", 0), ("search", "c1", 4), ("search", "c2", 5), ("stats", "", 4), ("stats", "", 5)]


# -- moments that take values back ----------------------------------------------------------------

def moments(spark, data):
    return spark.createDataFrame([(g, float(x)) for g, x in data], "g string, x double")


def close(got, want):
    got, want = ({r.g: (r.n, r.mean, r.m2) for r in t.collect()} for t in (got, want))
    assert set(got) == set(want)
    for g in got:
        assert got[g] == pytest.approx(want[g], rel=1e-9, abs=1e-9)


def test_changed_and_removed_rows_give_the_one_pass_moments(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.gauss(5, 2)) for _ in range(300)] + [("gone", 4.0), ("one", 1.0), ("one", 2.0)]
    removed = [r for k, r in enumerate(data) if k % 4 == 0 or r[0] == "gone"] + [("one", 2.0)] * (data[-1] == ("one", 2.0))
    removed = [r for r in removed if r[0] != "one"] + [("one", 2.0)]
    added = [("a", 8.0), ("new", 3.0), ("new", 5.0)]
    left = list(data)
    for r in removed:
        left.remove(r)
    g = GroupMoments(spark, "x", ["g"])
    g.update(moments(spark, data))
    after = moments(spark, left + added)
    close(g.change(moments(spark, removed), moments(spark, added), after), batch_moments(after, "x", ["g"]))


def test_cancelled_groups_are_doubtful_and_counted_anew(spark):
    small, huge = [("a", 1.0 + k / 7) for k in range(20)], [("a", 1e9 + k * 1e6) for k in range(20)]
    whole, gone = (batch_moments(moments(spark, d), "x", ["g"]) for d in (small + huge, huge))
    (row,) = retract_moments(whole, gone, ["g"]).collect()
    assert row.doubtful
    g = GroupMoments(spark, "x", ["g"])
    g.update(moments(spark, small + huge))
    after = moments(spark, small)
    close(g.change(moments(spark, huge), moments(spark, [("a", 1.0)]).limit(0), after), batch_moments(after, "x", ["g"]))


# -- snapshots --------------------------------------------------------------------------------------

def test_newest_committed_snapshot_is_read_alone(spark):
    base = scratch_path(spark, "snapshots")
    for ts, n in (("20240101", 3), ("20240201", 5), ("20240301", 9)):
        fl.write_table(spark.range(n), base, snapshot=ts)
    folders.remove(spark, f"{base}/snapshot=20240301/_SUCCESS")  # still being written
    assert folders.values(spark, base, "snapshot") == ["20240101", "20240201"]
    df = fl.read_latest_snapshot(spark, base)
    assert df.count() == 5 and df.columns == ["id"] and all("snapshot=20240201" in f for f in df.inputFiles())
    with pytest.raises(FileNotFoundError):
        fl.read_latest_snapshot(spark, scratch_path(spark, "nothing"))


# -- store of vectors by content, filter of known keys -------------------------------------------------

def test_vectors_are_stored_by_content_and_model(spark, tmp_path):
    store, calls = scratch_path(spark, "vectors"), tmp_path / "calls"
    calls.mkdir()

    def embedder():
        import uuid

        def run(contents):
            for c in contents:
                (calls / uuid.uuid4().hex).write_bytes(c)
            return [None if c == b"bad" else [float(len(c))] for c in contents]
        return run

    def images(rows):
        return spark.createDataFrame([(v, bytearray(c)) for v, c in rows], "video_id string, content binary")

    def vectors(rows, model="m1"):
        got = {r.video_id: (r.embedding, r.error) for r in fl.embed_store(images(rows), store, embedder, model).collect()}
        new = sorted(f.read_bytes() for f in calls.iterdir())
        for f in calls.iterdir():
            f.unlink()
        return got, new

    got, new = vectors([("a", b"x"), ("b", b"x"), ("c", b"yy"), ("d", b"bad")])
    assert got == {"a": ([1.0], None), "b": ([1.0], None), "c": ([2.0], None), "d": (None, "unreadable")}
    assert new == [b"bad", b"x", b"yy"]  # the copy was not embedded again
    got, new = vectors([("a", b"zzz"), ("b", b"x"), ("d", b"bad")])
    assert got["a"] == ([3.0], None) and new == [b"zzz"]  # only the changed image
    assert vectors([("a", b"zzz")], "m2")[1] == [b"zzz"]  # another model


def test_surely_new_rows_skip_the_store(spark):
    stored = spark.range(500).select(F.concat(F.lit("c"), "id").alias("channel_id"))
    fresh = spark.range(2000).select(F.concat(F.lit("c"), F.col("id") + 400).alias("channel_id"))
    known = ig.merge_filters(ig.known_filter(stored.limit(250), bits=1 << 14).unionByName(ig.known_filter(stored, bits=1 << 14)))
    assert known.count() <= (1 << 14) // 64
    marked = ig.maybe_known(fresh, known, bits=1 << 14)
    assert marked.columns == ["channel_id", "_maybe"]
    maybe = {r.channel_id for r in marked.where("_maybe").collect()}
    assert {f"c{k}" for k in range(400, 500)} <= maybe and len(maybe) < 200
    plain, filtered = ig.resume(stored, fresh), ig.resume(stored, fresh, known=known, bits=1 << 14)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, filtered.collect()))


@pytest.mark.parametrize("block_days", [1, 7, 4096])
def test_promotions_equal_the_plain_rule(spark, block_days):
    import datetime as dt
    from perfscore.operators.promote import promote_gate

    rng = random.Random(block_days)
    runs = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=d), rng.choice([None, rng.random() * d / 100, 0.2, d * 0.003]))
            for s in ("x", "y", None) for d in range(120)] + [("x", dt.date(2020, 1, 9), 0.9)] * 2
    expected = []
    for s in ("x", "y", None):
        champion = 0.0
        for _, day, metric in sorted((r for r in runs if r[0] == s), key=lambda r: (r[1], r[2] is not None, r[2] or 0)):
            won = None if metric is None else metric > champion + 0.005
            champion = metric if won else champion
            expected.append((s, day, metric, won, champion))
    got = promote_gate(spark.createDataFrame(runs, "segment string, run_day date, metric double"), block_days=block_days)
    assert "collect_list" not in got._jdf.queryExecution().toString()
    assert sorted(((r.segment, r.run_day, r.metric, r.promoted, r.champion) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_a_large_bucket_is_merged_by_several_tasks(spark, monkeypatch):
    from perfscore.streaming import keyed
    monkeypatch.setattr(keyed, "ROWS_PER_TASK", 100)
    table = keyed.KeyedTable(spark, scratch_path(spark, "keyed"), "k", ("at",), buckets=2)
    for at in (1, 2):
        table.merge(spark.range(2000).selectExpr("cast(id as string) AS k", f"{at}L AS at", f"id * {at} AS v"), at)
    rows = table.current()
    assert len(rows.inputFiles()) > 10  # two before: a task for each bucket
    got = {r.k: r.v for r in rows.collect()}
    assert got == {str(i): 2 * i for i in range(2000)} and rows.count() == 2000
