"""Model pieces: ridge parity with the closed form, assembler order, save/load."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from perfscore.functions.features import TAB_FEATURES
from perfscore.operators import models as md
from perfscore.operators.features import apply_scaler, fit_scaler
from perfscore.session import materialize, scratch_path


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    n, p, alpha = 200, 3, 50.0
    X = rng.normal(size=(n, p))
    y = X @ np.array([1.0, -2.0, 0.5]) + rng.normal(scale=0.3, size=n) + 3.0
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(f"v{i}", *map(float, X[i]), float(y[i])) for i in range(n)],
                               "video_id string, a double, b double, c double, y double")
    w = {r.feature: r.weight for r in md.ridge_weights(df, cols, "y", alpha).collect()}
    # sklearn Ridge: centre X and y, solve (Xc'Xc + alpha I) w = Xc'yc
    Xc, yc = X - X.mean(0), y - y.mean()
    ref = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(p), Xc.T @ yc)
    assert [w[c] for c in cols] == pytest.approx(ref.tolist(), rel=1e-6, abs=1e-9)


def test_scaler_uses_population_std_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    s = fit_scaler(df, ["x", "k"])
    assert s["x"] == (2.0, 1.0) and s["k"] == (5.0, 1.0)
    assert [tuple(r) for r in apply_scaler(df, s).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_assembler_order_and_save_load(spark):
    rng = np.random.default_rng(1)
    rows = [(f"v{i}", [float(v) for v in rng.normal(size=4)], *[float(v) for v in rng.normal(size=len(TAB_FEATURES))],
             float(rng.normal())) for i in range(60)]
    schema = "video_id string, embedding array<double>, " + ", ".join(f"{c} double" for c in TAB_FEATURES) + ", y double"
    df = spark.createDataFrame(rows, schema)
    data = df.withColumn("emb", array_to_vector("embedding")).drop("embedding")
    assert md.assembler().getInputCols() == ["emb", *TAB_FEATURES]
    model = md.fit_final(data)
    path = md.save_model(model, scratch_path(spark, "model_test"))
    a = model.transform(data).select("video_id", "prediction").orderBy("video_id").collect()
    b = md.load_model(path).transform(data).select("video_id", "prediction").orderBy("video_id").collect()
    assert [r.prediction for r in a] == pytest.approx([r.prediction for r in b])


def test_constant_columns_leave_an_exact_fit_and_bounds_travel_with_the_model(spark):
    rng = np.random.default_rng(4)
    x, fixed = rng.normal(size=(80, 3)), {"niche_ai": 1.0, "bg_blur": 0.0}
    free = [c for c in TAB_FEATURES if c not in fixed]
    X = np.hstack([x, rng.integers(0, 2, (80, len(free) - 3)).astype(float)])
    y = X[:, 0] + rng.normal(size=80)
    rows = [(f"v{i:02d}", *[float(v) for v in X[i]], *fixed.values(), float(y[i])) for i in range(80)]
    df = spark.createDataFrame(rows, "video_id string, " + ", ".join(f"{c} double" for c in [*free, *fixed]) + ", y double")
    model = md.fit_final(df, with_embedding=False, alpha=2.0)
    Z = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(Z.T @ Z + 2.0 * np.eye(Z.shape[1]), Z.T @ (y - y.mean()))
    expected = y.mean() + Z @ w
    path = md.save_model(md.with_bounds(model, -1.0, 3.0), scratch_path(spark, "bounded"))
    got = md.batch_score(md.load_model(path), df).orderBy("video_id").collect()
    assert [r.prediction for r in got] == pytest.approx(expected.tolist(), abs=1e-10)
    assert [r.score_20 for r in got] == pytest.approx(np.clip((expected + 1) * 5, 0, 20).tolist(), abs=0.0501)
    flat = md.batch_score(md.with_bounds(model, 1.0, 1.0), df).collect()
    assert {r.score_20 for r in flat} == {None}


def test_gbt_learns_a_step(spark):
    rng = np.random.default_rng(2)
    n = 300
    x = rng.normal(size=n)
    y = 2.0 * (x > 0) + rng.normal(scale=0.1, size=n)
    cols = list(TAB_FEATURES)
    rows = [(f"v{i}", *([float(x[i])] + [0.0] * (len(cols) - 1)), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "video_id string, " + ", ".join(f"{c} double" for c in cols) + ", y double")
    model = md.fit_final(df, "gbt", with_embedding=False)
    pred = np.array([r.prediction for r in model.transform(df).orderBy("video_id").collect()])
    truth = np.array([r.y for r in df.orderBy("video_id").collect()])
    assert np.corrcoef(pred, truth)[0, 1] > 0.95


def fold_data(spark, n=240):
    rng = np.random.default_rng(5)
    rows = [(f"v{i}", f"g{i % 7}" if i % 11 else None, float(rng.gamma(2.0)), *[float(v) for v in rng.integers(0, 2, len(TAB_FEATURES) - 2)],
             float(rng.normal(8, 1))) for i in range(n)]
    cols = [c for c in TAB_FEATURES if c != "channel_avg_perf"]
    return spark.createDataFrame(rows, "video_id string, g string, v double, " + ", ".join(f"{c} double" for c in cols))


def test_one_pass_ridge_equals_a_fit_per_fold(spark):
    data = fold_data(spark).withColumnRenamed("v", "y").withColumn("channel_avg_perf", F.lit(0.5)).drop("g")
    got = {r.video_id: r for r in md.cross_val_predictions(data, "ridge", with_embedding=False, alpha=3.0).collect()}
    scaled = apply_scaler(data, fit_scaler(data)).toPandas().set_index("video_id")
    fold = np.array([got[v].fold for v in scaled.index])
    X, y = scaled[list(TAB_FEATURES)].to_numpy(), scaled["y"].to_numpy()
    for f in range(5):
        A, b = X[fold != f], y[fold != f]
        w = np.linalg.solve((A - A.mean(0)).T @ (A - A.mean(0)) + 3.0 * np.eye(A.shape[1]), (A - A.mean(0)).T @ (b - b.mean()))
        expected = b.mean() + (X[fold == f] - A.mean(0)) @ w
        assert [got[v].prediction for v in scaled.index[fold == f]] == pytest.approx(expected.tolist(), abs=1e-9)


def test_split_stats_are_those_of_the_other_folds(spark):
    from perfscore.operators.features import assign_folds
    from perfscore.operators.stats import group_stats

    data = materialize(assign_folds(fold_data(spark), k=5), "folds")
    got = {r.g: r for r in md.split_stats(data, "v", "g", 5).collect()}
    for f in range(5):
        for r in group_stats(data.where(F.col("fold") != f), "v", "g").collect():
            assert (got[r.g]["_means"][f], got[r.g]["_stds"][f]) == pytest.approx((r["_mean"], r["_std"]))
    one = md.split_stats(data.where("video_id in ('v1', 'v2')"), "v", "g", 5).collect()
    assert all(r["_stds"] == [None] * 5 for r in one)


def test_the_rows_are_aggregated_by_group_once(spark):
    from perfscore.operators.features import assign_folds

    plan = md.split_stats(assign_folds(fold_data(spark)), "v", "g", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("var_pop") >= 1 and sum("var_pop" in line for line in plan.splitlines()) == 1


def test_vectors_are_written_as_they_came(spark):
    from perfscore.operators.features import attach_vectors, keyed_vectors

    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "video_id string, y double")
    emb = spark.createDataFrame([("a", [0.5, 0.1]), ("b", [1.5, 0.2]), ("d", [2.5, 0.3])], "video_id string, embedding array<float>")
    found = attach_vectors(rows, keyed_vectors(emb), "attached")
    kept = {f.rsplit("/", 1)[0] for f in found.inputFiles()}
    assert len(kept) == 1 and "attached-" in min(kept)  # read from the table, not joined again
    assert dict(spark.read.parquet(*kept).dtypes)["embedding"] == "array<float>"
    assert found.columns == ["video_id", "y", "emb"]
    want = {"a": [float(np.float32(x)) for x in (0.5, 0.1)], "b": [float(np.float32(x)) for x in (1.5, 0.2)]}
    assert {r.video_id: list(r.emb) for r in found.collect()} == want


def test_tree_fits_read_assembled_rows_and_share_the_memory(spark, monkeypatch):
    import threading
    import time

    from pyspark.ml.regression import GBTRegressor

    data = materialize(fold_data(spark).withColumnRenamed("v", "y").withColumn("channel_avg_perf", F.lit(0.5)).drop("g"), "rows")
    fit, lock, running, most, read = GBTRegressor.fit, threading.Lock(), [], [], []

    def watched(self, train, params=None):
        with lock:
            running.append(1)
            most.append(len(running))
            read.append((train.columns, {f.rsplit("/", 2)[1].split("-")[0] for f in train.inputFiles()}))
        try:
            time.sleep(0.5)
            return fit(self, train, params)
        finally:
            with lock:
                running.pop()

    monkeypatch.setattr(GBTRegressor, "fit", watched)
    found = {}
    for held, wanted in ((md.TREE_ROW_BYTES, 5), (1 << 50, 1)):  # rows that fit the memory, and rows that exceed it
        monkeypatch.setattr(md, "TREE_ROW_BYTES", held)
        most.clear()
        found[wanted] = {r.video_id: r for r in md.cross_val_predictions(data, "gbt", with_embedding=False).collect()}
        assert max(most) == wanted
    assert all(r == (["video_id", "fold", "y", "features"], {"assembled"}) for r in read) and len(read) == 10
    one, scaler = found[1], fit_scaler(data)

    def alike(a, b):  # splits of equal gain are chosen by the rounding of sums, whose order varies
        return np.isclose(a, b, rtol=1e-6).mean() > 0.9

    assert len(one) == data.count() and alike([r.prediction for r in one.values()], [found[5][v].prediction for v in one])
    fold = spark.createDataFrame([(v, r.fold) for v, r in one.items()], "video_id string, fold long")
    rows = data.join(fold, "video_id")
    for f in (0, 3):
        plain = md.regression_pipeline("gbt", 0, 0.0, with_embedding=False, scaler=scaler).fit(rows.where(F.col("fold") != f))
        want = {r.video_id: r.prediction for r in plain.transform(rows.where(F.col("fold") == f)).collect()}
        assert alike([one[v].prediction for v in want], list(want.values()))


def test_the_classifiers_fits_share_the_memory_too(spark, monkeypatch):
    data = fold_data(spark).withColumns({"label": (F.col("v") > 2.5).cast("int"), "channel_avg_perf": F.lit(0.5)}).drop("g", "v")
    each, asked = md._each_fold, []
    monkeypatch.setattr(md, "_each_fold", lambda fit, k, at_once: (asked.append(at_once), each(fit, k, at_once))[1])
    for held in (md.TREE_ROW_BYTES, 1 << 50):
        monkeypatch.setattr(md, "TREE_ROW_BYTES", held)
        out, auc = md.top_quartile_classifier(data, with_embedding=False, k=2, max_iter=1, parallelism=2)
        assert out.count() == data.count() and 0 <= auc <= 1
    assert asked == [2, 1]
