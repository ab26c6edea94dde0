"""Operator properties and unit-only operators."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfscore.operators import explore as ex
from perfscore.operators import ingest as ig
from perfscore.operators import stats as st
from perfscore.operators.features import assign_folds, rescale
from perfscore.operators.promote import promote_gate
from perfscore.session import scratch_path
from perfscore.sources import files as fl
from perfscore.streaming.refresh import GroupMoments


@pytest.fixture
def byte_histogram_embedder():
    def make(dim: int = 64):
        """Deterministic stand-in for an image network: normalised byte histogram."""
        import numpy as np

        def embed(batch: list[bytes]) -> list[list[float] | None]:
            out = []
            for content in batch:
                if not content:
                    out.append(None)
                    continue
                arr = np.frombuffer(content, dtype=np.uint8)
                hist = np.bincount(arr // (256 // dim), minlength=dim)[:dim].astype(np.float64)
                out.append((hist / hist.sum()).astype(np.float32).tolist())
            return out

        return embed

    return make


@pytest.fixture()
def groups(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 3.0), ("c", 5.0), ("c", 5.0), (None, 7.0)]
    return spark.createDataFrame([(f"v{i}", g, x) for i, (g, x) in enumerate(rows)],
                                 "video_id string, g string, x double")


def test_zscore_edges(groups):
    z = {r.video_id: r.z for r in st.zscore_within(groups, "x", "g").collect()}
    assert z["v3"] is None            # one-row group
    assert z["v4"] == 0.0 and z["v5"] == 0.0   # equal values
    assert z["v6"] is None            # NULL group key
    a = np.array([1.0, 2.0, 4.0])
    assert z["v0"] == pytest.approx((1.0 - a.mean()) / (a.std(ddof=1) + 1e-9))


def test_aggregate_join_equals_window(groups):
    from pyspark.sql import Window

    a = {r.video_id: r.z for r in st.zscore_within(groups, "x", "g").collect()}
    own = Window.partitionBy("g")
    z = st.zscore("x", F.avg("x").over(own), F.stddev_samp("x").over(own))
    w = {r.video_id: r.z for r in groups.withColumn("z", F.when(F.col("g").isNotNull(), z)).collect()}
    assert a.keys() == w.keys()
    for k in a:
        assert (a[k] is None and w[k] is None) or a[k] == pytest.approx(w[k])


def test_z_properties(spark):
    rng = np.random.default_rng(7)
    rows = [(f"v{i}", f"g{i % 3}", float(rng.normal(i % 3, 1))) for i in range(300)]
    df = st.zscore_within(spark.createDataFrame(rows, "video_id string, g string, x double"), "x", "g")
    s = df.groupBy("g").agg(F.avg("z").alias("m"), F.stddev_samp("z").alias("s")).collect()
    for r in s:
        assert abs(r.m) < 1e-9 and r.s == pytest.approx(1.0, abs=1e-6)


def test_incremental_moments_equal_one_pass(spark, groups):
    m = GroupMoments(spark, "x", ["g"], "test_moments")
    part = F.pmod(F.xxhash64("video_id"), F.lit(3))
    for b in range(3):
        m.update(groups.where(part == b))
    inc = {r.video_id: r.z for r in m.zscore(groups).collect()}
    one = {r.video_id: r.z for r in st.zscore_within(groups, "x", "g").collect()}
    for k in one:
        assert (inc[k] is None and one[k] is None) or inc[k] == pytest.approx(one[k], abs=1e-9)


def test_pearson_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, float("nan"), 5.0), (4.0, None, 5.0)],
                               "s double, raw double, norm double")
    out = {r.target: r.corr for r in st.pearson_pair(df, "s", "raw", "norm").collect()}
    assert out == {"raw": 1.0, "within_group": None}


def test_lift_and_diff_agree_in_sign(spark):
    rows = [(f"v{i}", i % 2 == 0, float(i % 2 == 0) * 2 + 1) for i in range(20)]
    df = spark.createDataFrame(rows, "video_id string, f boolean, y double")
    flags = {"f": F.col("f")}
    lift = st.feature_lift(df, flags, "y").first().lift
    diff = st.feature_diff(df, flags, "y").first().diff
    assert (lift > 1) == (diff > 0) and lift == 3.0 and diff == 2.0


def test_value_counts_drop_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", None)], "x string, y int")
    out = sorted(tuple(r) for r in ex.value_counts_multi(df, ["x", "y"]).collect())
    assert out == [("x", "a", 2), ("y", "1", 2)]


def test_value_counts_orders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("c",), ("c",)], "x string")
    by_freq = [(r.value, r.n) for r in ex.value_counts_multi(df, ["x"], order="frequency").collect()]
    by_value = [r.value for r in ex.value_counts_multi(df, ["x"], order="value").collect()]
    assert by_freq == [("c", 3), ("b", 2), ("a", 1)] and by_value == ["a", "b", "c"]


def test_duplicates_count_nulls_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert ex.duplicate_counts(df, ["k"]).first().n_duplicates == 2


def test_cap_per_group_keeps_order(spark):
    df = spark.createDataFrame([("c1", 0, i) for i in range(10)] + [("c2", 0, 0)],
                               "channel_id string, page_no int, pos int")
    out = ig.cap_per_group(df, 3).collect()
    assert sorted((r.channel_id, r.pos) for r in out) == [("c1", 0), ("c1", 1), ("c1", 2), ("c2", 0)]


def test_niche_default_and_resume(spark):
    v = spark.createDataFrame([("v1", "c1"), ("v2", "c9")], "video_id string, channel_id string")
    m = spark.createDataFrame([("c1", "AI/Tech")], "channel_id string, niche string")
    assert {r.video_id: r.niche for r in ig.niche_lookup(v, m).collect()} == {"v1": "AI/Tech", "v2": "General"}
    stored = v.where("channel_id = 'c1'")
    fresh = spark.createDataFrame([("v1", "c1"), ("v3", "c1"), ("v2", "c9")], "video_id string, channel_id string")
    got = sorted((r.video_id, r.origin) for r in ig.resume(stored, fresh).collect())
    assert got == [("v1", "stored"), ("v2", "new")]


@pytest.mark.parametrize("rows_per_part", [3, 50, 50_000])
def test_folds_are_of_equal_size_and_stable_under_repartition(spark, rows_per_part):
    df = spark.range(203).select(F.col("id").cast("string").alias("video_id"))
    a = {r.video_id: r.fold for r in assign_folds(df, rows_per_part=rows_per_part).collect()}
    b = {r.video_id: r.fold for r in assign_folds(df.repartition(7), rows_per_part=50_000).collect()}
    sizes = [list(a.values()).count(f) for f in range(5)]
    assert a == b and len(a) == 203 and max(sizes) - min(sizes) <= 1
    assert {r.video_id: r.fold for r in assign_folds(df, seed=7).collect()} != a
    assert assign_folds(df.limit(0)).count() == 0
    assert assign_folds(spark.createDataFrame([(None,), ("a",), ("a",)], "video_id string")).count() == 3


def test_rescale_clip_and_round(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (0.25,), (9.0,)], "x double")
    assert [r[0] for r in df.select(rescale("x", -1.0, 1.0)).collect()] == [0.0, 10.0, 12.5, 20.0]


def test_promote_gate_sequence(spark):
    import datetime as dt
    runs = [("s", dt.date(2024, 1, d), m) for d, m in ((1, 0.004), (2, 0.006), (3, 0.010), (4, 0.0111), (5, 0.02))]
    df = spark.createDataFrame(runs, "segment string, run_day date, metric double")
    out = [(r.promoted, r.champion) for r in promote_gate(df).orderBy("run_day").collect()]
    assert out == [(False, 0.0), (True, 0.006), (False, 0.006), (True, 0.0111), (True, 0.02)]


def test_csv_roundtrip_keeps_quotes_newlines_and_empty(spark):
    df = spark.createDataFrame([("1", 'He said "hi"\nthen left '), ("2", ""), ("3", None), ("4", "NA")],
                               "video_id string, texte_contenu string")
    path = scratch_path(spark, "csv_test")
    fl.write_table(df, path, fmt="csv")
    back = fl.read_csv_table(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_snapshot_reads_latest(spark):
    path = scratch_path(spark, "snap_test")
    fl.write_table(spark.createDataFrame([("old",)], "v string"), path, snapshot="20240101")
    fl.write_table(spark.createDataFrame([("new",)], "v string"), path, snapshot="20240102")
    assert [r.v for r in fl.read_latest_snapshot(spark, path).collect()] == ["new"]


@pytest.fixture()
def image_dir(tmp_path):
    d = tmp_path / "imgs"
    d.mkdir()
    (d / "v1.jpg").write_bytes(bytes(range(256)) * 4)
    (d / "v2.png").write_bytes(b"\x89PNG" + bytes(100))
    (d / "v3.gif").write_bytes(b"GIF89a")
    (d / "v4.webp").write_bytes(b"BAD")
    return str(d)


def test_scan_admit_attach(spark, image_dir):
    imgs = fl.scan_images(spark, image_dir)
    assert sorted(r.video_id for r in imgs.collect()) == ["v1", "v2", "v3", "v4"]
    ok = fl.admit_images(imgs)
    assert sorted(r.video_id for r in ok.collect()) == ["v1", "v2", "v4"]
    assert fl.admit_images(imgs, max_bytes=200).select("video_id").orderBy("video_id").collect()[0].video_id == "v2"
    videos = spark.createDataFrame([("v1", "u"), ("v2", None), ("v9", "u")], "video_id string, thumbnail_url string")
    got = {r.video_id: r.thumbnail_path for r in ig.attach_thumbnail_path(videos, ok).collect()}
    assert got["v1"].endswith("v1.jpg") and got["v2"] is None and got["v9"] is None


def test_embed_images_pluggable(spark, image_dir, byte_histogram_embedder):
    raw = spark.read.format("binaryFile").load(image_dir)
    imgs = raw.select(F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1).alias("video_id"), "content")
    def make():
        base = byte_histogram_embedder()

        def embed(batch):
            if any(c.startswith(b"BAD") for c in batch):
                raise ValueError("cannot decode")
            return base(batch)
        return embed

    out = {r.video_id: r for r in fl.embed_images(imgs, make).collect()}
    assert len(out["v1"].embedding) == 64 and abs(sum(out["v1"].embedding) - 1) < 1e-5
    assert out["v2"].embedding is not None            # same batch as the bad row, retried alone
    assert out["v4"].embedding is None and out["v4"].error == "cannot decode"
    existing = spark.createDataFrame([("v1",)], "video_id string")
    assert sorted(r.video_id for r in fl.missing_embeddings(imgs, existing).collect()) == ["v2", "v3", "v4"]


def test_load_admitted_images_then_embed(spark, image_dir, byte_histogram_embedder):
    imgs = fl.load_admitted_images(spark, image_dir, max_bytes=500)
    assert sorted(r.video_id for r in imgs.collect()) == ["v2", "v4"]   # v1 too big, v3 gif
    out = {r.video_id: r.error for r in fl.embed_images(imgs, byte_histogram_embedder).collect()}
    assert set(out) == {"v2", "v4"}


def test_positive_in_both(spark):
    d = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", -0.1)], "feature string, diff double")
    w = spark.createDataFrame([("a", 0.5), ("b", -0.5), ("c", 0.3)], "feature string, weight double")
    assert [r.feature for r in st.positive_in_both(d, w).collect()] == ["a"]


def test_predictions_roundtrip_by_key(spark):
    df = spark.createDataFrame([(f"v{i}", i / 10) for i in range(30)], "video_id string, prediction double")
    path = scratch_path(spark, "pred_test")
    fl.write_predictions(df.repartition(4), path)
    local = path[len("file:"):] if path.startswith("file:") else path
    assert len([f for f in os.listdir(local) if f.startswith("part-")]) > 1   # all files are read
    back = {r.video_id: r.prediction for r in fl.read_predictions(spark, path).collect()}
    assert back == {r.video_id: r.prediction for r in df.collect()}


def test_exact_quantiles_match_numpy(spark):
    from perfscore.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", float(rng.normal())) for i in range(1500)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 3.0), (None, 1.0), ("two", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["g"]).collect()}
    groups = {}
    for g, x in rows:
        if g is not None and not np.isnan(x):
            groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        ref = np.quantile(xs, [0.25, 0.5, 0.75])
        r = got[g]
        assert r.n == len(xs)
        assert [r.q_0_25, r.q_0_5, r.q_0_75] == pytest.approx(ref.tolist(), abs=1e-12)
    whole = exact_quantiles(df, "x", [0.5]).first()
    assert whole.q_0_5 == pytest.approx(float(np.quantile([x for g, x in rows if not np.isnan(x)], 0.5)))


def test_sides_are_broadcast_by_their_bytes(spark):
    from perfscore.operators.joins import lookup_join, small_side, stats_join
    big = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(20).withColumnRenamed("id", "k")
    rows = [(f"v{i}", "hot" if i % 3 else f"g{i % 40}", float(i % 17)) for i in range(1200)] + [("vn", None, 1.0)]
    df = spark.createDataFrame(rows, "video_id string, g string, x double")
    stats = st.group_stats(df, "x", ["g"])
    ref = {r.video_id: r._mean for r in df.join(stats, ["g"], "left").collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold, wanted in (("10485760", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            sided, joined = big.join(small_side(dim), "k"), stats_join(df, stats, ["g"])
            assert all(wanted in d._jdf.queryExecution().executedPlan().toString() for d in (sided, joined))
            assert sided.count() == lookup_join(big, dim, "k").count() == 20
            assert {r.video_id: r._mean for r in joined.collect()} == ref
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_equal_values_do_not_pile_up_in_the_quantile_plan(spark):
    from perfscore.operators import quantiles

    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 7.0).otherwise(F.col("id") * 1.0).alias("x"))
    kept = []
    real = quantiles.materialize
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        quantiles.materialize = lambda d, name: kept.append(real(d, name)) or kept[-1]
        row = quantiles.exact_quantiles(df, "x", [0.5, 0.95]).first()
    finally:
        quantiles.materialize = real
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    xs = [r.x for r in df.collect()]
    assert (row.n, row.q_0_5) == (20_000, 7.0) and row.q_0_95 == pytest.approx(float(np.quantile(xs, 0.95)))
    sizes = [r["count"] for r in kept[0].groupBy("_p").count().collect()]
    assert max(sizes) <= 0.6 * sum(sizes) and sum(sizes) == 2001  # 18,000 equal rows are one
    plan = quantiles.exact_quantiles(df, "x", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_and_constant_inputs_give_null_not_an_error(spark):
    from perfscore.operators import explore, features

    df = spark.createDataFrame([("a", 2.0, True), ("b", 2.0, False)], "video_id string, x double, f boolean")
    assert [r.score_20 for r in features.rescale_3sigma(df, "x").collect()] == [None, None]
    assert explore.flag_stats(df.limit(0), ["f"]).first().pct_true is None


def test_nan_ranks_last(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0), ("c", None), ("d", 2.0)], "video_id string, x double")
    assert [r.video_id for r in st.top_k(df, "x", 2).collect()] == ["d", "b"]
    assert [r.video_id for r in st.top_k(df, "x", 2, ascending=True).collect()] == ["b", "d"]


def test_a_flip_is_decided_before_rounding(spark):
    rows = [("a", True, 1.02, 3e-7), ("b", False, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "video_id string, on boolean, raw double, norm double")
    row = st.confound_flips(df, {"f": F.col("on")}, "raw", "norm").first()
    assert (row.lift, row["diff"], row.flipped) == (1.02, 0.0, False)
