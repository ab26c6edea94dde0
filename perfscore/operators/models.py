"""Model fitting, cross-validation and batch scoring with Spark ML.

The reference trains a small neural network on one machine; here the same
inputs ([embedding, 20 tabular features] → within-group z) feed Spark ML
estimators whose fitting is distributed (normal equations / tree statistics
are aggregated across partitions).  Ridge fits of all folds come from one pass
(``operators.gram``); tree fits of the folds run concurrently from driver
threads, as ``CrossValidator(parallelism=…)`` does.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.functions.features import TAB_FEATURES
from perfscore.functions.stats import finite, pearson, zscore
from perfscore.operators import gram
from perfscore.operators.features import (KeyedVectors, apply_scaler, assign_folds, attach_vectors, feature_columns,
                                          fit_moments, fit_scaler, keyed_vectors, rescale_stage, scaler_stage)
from perfscore.operators.joins import small_side
from perfscore.session import materialize

TREE_ROW_BYTES = 300        # memory of a row in a tree fit, beside 4 bytes per feature
TREE_EVEN_ROWS = 200_000    # rows of a tree fit from which its passes, not its jobs, take the time
RIDGE_ALPHA = 50.0          # fixed value: ridge strength of the weight analysis


def assembler(tab_cols: Sequence[str] = TAB_FEATURES, with_embedding: bool = True) -> VectorAssembler:
    cols = (["emb"] if with_embedding else []) + list(tab_cols)
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")


def ridge(alpha: float, n: int, std_y: float, label: str = "y") -> LinearRegression:
    """Ridge with the penalty of ``alpha * ||w||²`` on unscaled inputs.

    Spark's L2 term is ``regParam/2 · ||w||²`` on a loss divided by ``n`` and
    scaled by the label deviation, hence ``regParam = alpha · std_pop(y) / n``.
    """
    reg = alpha * std_y / n if n else 0.0
    return LinearRegression(featuresCol="features", labelCol=label, regParam=reg,
                            elasticNetParam=0.0, standardization=False, solver="normal")


def _label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(row["n"]), float(row["s"] or 0.0)


def tab_array(tab_cols: Sequence[str] = TAB_FEATURES, with_embedding: bool = False):
    """All model inputs as one array: the embedding, if any, then the tabular features."""
    tab = F.array(*[F.col(c).cast("double") for c in tab_cols])
    return F.concat(vector_to_array("emb"), tab) if with_embedding else tab


def _widths(df: DataFrame, tab_cols: Sequence[str], with_embedding: bool) -> tuple[int, int]:
    """Number of model inputs, and of those that are not scaled (the embedding)."""
    lead = 0
    if with_embedding:
        row = df.select(F.size(vector_to_array("emb")).alias("n")).first()
        lead = row["n"] if row else 0
    return lead + len(tab_cols), lead


def ridge_weights(df: DataFrame, tab_cols: Sequence[str] = TAB_FEATURES, label: str = "y",
                  alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Ridge coefficients of the tabular features on the target, from one pass."""
    g = gram.fold_grams(df, 1, len(tab_cols), tab_array(tab_cols), F.array(F.col(label).cast("double")), F.array(F.lit(True)))
    weights = gram.solve_ridge(g[0], alpha).weights.tolist()
    return df.sparkSession.createDataFrame(list(zip(tab_cols, weights)), "feature string, weight double")


def regression_pipeline(kind: str, n: int, std_y: float, label: str = "y",
                        tab_cols: Sequence[str] = TAB_FEATURES, with_embedding: bool = True,
                        alpha: float = 1.0, seed: int = 42, scaler: dict | None = None,
                        max_iter: int = 20, max_depth: int = 3) -> Pipeline:
    """Scaler (if one is given), assembler and estimator as one pipeline, saved and loaded whole."""
    if kind == "ridge":
        est = ridge(alpha, n, std_y, label)
    elif kind == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    if scaler is None:
        return Pipeline(stages=[assembler(tab_cols, with_embedding), est])
    scaled = [f"scaled_{c}" for c in tab_cols]
    return Pipeline(stages=[scaler_stage(scaler), assembler(scaled, with_embedding), est])


def cross_val_predictions(df: DataFrame, kind: str = "ridge", k: int = 5, seed: int = 42,
                          label: str = "y", with_embedding: bool = True, parallelism: int = 5,
                          alpha: float = 1.0, vectors: KeyedVectors | None = None) -> DataFrame:
    """Out-of-fold predictions: ``video_id, fold, y, prediction``.

    ``vectors`` are attached after the folds are dealt, to rows that do not hold theirs yet (``features.training_rows``).

    The scaler is fitted once over all rows, before the folds, as the reference does
    (P22); ``cross_val_predictions_fold_safe`` fits it inside each training split.
    """
    folded = assign_folds(df, "video_id", seed, k)
    data = materialize(folded, "folds") if vectors is None else attach_vectors(folded, vectors, "folds")
    if kind == "ridge":
        return _ridge_folds(data, k, label, with_embedding, alpha)
    *inputs, tree = regression_pipeline(kind, 0, 0.0, label, with_embedding=with_embedding, alpha=alpha, seed=seed,
                                        scaler=fit_scaler(data)).getStages()
    ready = _assembled(data, inputs, label)

    def fit_fold(f: int) -> DataFrame:
        model = tree.fit(ready.where(F.col("fold") != f))
        return model.transform(ready.where(F.col("fold") == f)).select(
            "video_id", "fold", F.col(label).alias("y"), "prediction")

    return _each_fold(fit_fold, k, _fits_at_once(ready, _widths(data, TAB_FEATURES, with_embedding)[0], parallelism))


def _ridge_folds(data: DataFrame, k: int, label: str, with_embedding: bool, alpha: float) -> DataFrame:
    """Out-of-fold ridge predictions: one pass for all fits, one for the predictions."""
    width, lead = _widths(data, TAB_FEATURES, with_embedding)
    x = tab_array(with_embedding=with_embedding)
    cells = F.sequence(F.lit(0), F.lit(k - 1))
    grams = gram.fold_grams(data, k, width, x, F.transform(cells, lambda _: F.col(label).cast("double")),
                            F.transform(cells, lambda c: F.col("fold") == c))
    scale = gram.deviations(grams.sum(axis=0), lead)
    models = [gram.solve_ridge(g, alpha, scale) for g in gram.other_cells(grams)]
    return gram.with_predictions(data, models, "fold", x).select("video_id", "fold", F.col(label).alias("y"), "prediction")


def _assembled(data: DataFrame, inputs: list, label: str) -> DataFrame:
    """``video_id, fold``, the label and ``features``, made once for the fits of all folds and written in one part per core.

    A tree fit goes over its rows some sixty times, and each time waits for its longest task: the parts are equal.  Few rows
    stay in the parts they have, from which Spark draws the candidates of its splits.
    """
    if data.count() >= TREE_EVEN_ROWS:
        data = data.repartition(data.sparkSession.sparkContext.defaultParallelism, "video_id")
    rows = PipelineModel(inputs).transform(data)
    return materialize(rows.select("video_id", "fold", label, "features"), "assembled")


def _fits_at_once(rows: DataFrame, width: int, parallelism: int) -> int:
    """How many tree fits run together: as many as the executors' storage memory holds, one at least.

    Each fit keeps its binned rows, pseudo-residuals and errors in memory, and what does not fit is read from disk in each of
    its passes.
    """
    status = rows.sparkSession.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator()
    memory = 0
    while status.hasNext():
        memory += status.next()._1()
    held = rows.count() * (TREE_ROW_BYTES + 4 * width)
    return max(1, min(parallelism, memory // max(held, 1)))


def _each_fold(fit_fold, k: int, parallelism: int) -> DataFrame:
    """The folds' results, fitted from a few driver threads."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        return reduce(DataFrame.unionByName, pool.map(fit_fold, range(k)))


def cross_val_predictions_fold_safe(scored: DataFrame, embeddings: DataFrame | None = None,
                                    value: str = "performance_score", group: str = "channel_name",
                                    kind: str = "ridge", k: int = 5, seed: int = 42,
                                    parallelism: int = 5, alpha: float = 1.0) -> DataFrame:
    """Out-of-fold predictions without leakage.

    For each fold the within-group z target, the group mean feature and the
    scaler are fitted on the training folds only and applied to the held-out
    fold.  The groups are aggregated once, per fold.  A held-out group unseen in training gets the overall training mean
    as its group feature and no target (so it is not scored).
    """
    with_emb = embeddings is not None
    vectors = keyed_vectors(embeddings) if with_emb else None
    if with_emb:
        scored = scored.join(vectors.names, "video_id")
    folded = assign_folds(scored, "video_id", seed, k)
    if kind == "ridge":
        return _ridge_folds_safe(materialize(folded, "folds"), value, group, vectors, k, alpha)
    base = attach_vectors(folded, vectors, "folds") if with_emb else materialize(folded, "folds")
    kept = ("y", "fold", *(("emb",) if with_emb else ()))
    splits = materialize(split_stats(base, value, group, k), "splits")
    overall = _split_means(base, value, k)

    def fit_fold(f: int) -> DataFrame:
        train, held = base.where(F.col("fold") != f), base.where(F.col("fold") == f)

        def prep(df: DataFrame) -> DataFrame:
            j = df.join(splits, group, "left")
            j = (j.withColumn("y", zscore(value, F.col("_means")[f], F.col("_stds")[f]))
                  .withColumn("channel_avg_perf", F.coalesce(F.col("_means")[f], F.lit(overall[f]))))
            return feature_columns(j, keep=kept)

        tr = prep(train).where(finite("y"))
        scaler = fit_scaler(tr)
        tr, te = apply_scaler(tr, scaler), apply_scaler(prep(held).where(finite("y")), scaler)
        n, s = _label_stats(tr, "y")
        model = regression_pipeline(kind, n, s, "y", with_embedding=with_emb, alpha=alpha,
                                    seed=seed).fit(tr)
        return model.transform(te).select("video_id", "fold", "y", "prediction")

    return _each_fold(fit_fold, k, _fits_at_once(base, _widths(base, TAB_FEATURES, with_emb)[0], parallelism))


def split_stats(rows: DataFrame, value: str, group: str, k: int) -> DataFrame:
    """Per group the mean and sample deviation of every training split: arrays ``_means`` and ``_stds``.

    One aggregate over the rows gives the moments of each (group, fold); a split's are those of
    the other folds, merged pairwise (at most k per group).
    """
    folds = (rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, "fold")
             .agg(F.count(value).cast("double").alias("n"), F.avg(value).alias("m"),
                  (F.var_pop(value) * F.count(value)).alias("q")))
    groups = folds.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("fold", "n", "m", "q"))).alias("_folds"))
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def merged(a, b):
        n, d = a["n"] + b["n"], b["m"] - a["m"]
        return F.struct(n.alias("n"), (a["m"] + d * b["n"] / n).alias("m"),
                        (a["q"] + b["q"] + d * d * a["n"] * b["n"] / n).alias("q"))

    splits = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.aggregate(
        F.filter("_folds", lambda s: s["fold"] != f), none, merged))
    return groups.select(
        group, F.transform(splits, lambda s: F.when(s["n"] > 0, s["m"])).alias("_means"),
        F.transform(splits, lambda s: F.when(s["n"] > 1, F.sqrt(s["q"] / (s["n"] - 1)))).alias("_stds"))


def _split_means(rows: DataFrame, value: str, k: int) -> list[float | None]:
    """The mean of ``value`` over every training split (one row per fold to the driver)."""
    per_fold = {r["fold"]: (r["n"], r["s"]) for r in rows.groupBy("fold").agg(
        F.count(value).alias("n"), F.coalesce(F.sum(value), F.lit(0.0)).alias("s")).collect()}
    out = []
    for f in range(k):
        n = sum(c for g, (c, _) in per_fold.items() if g != f)
        out.append(sum(t for g, (_, t) in per_fold.items() if g != f) / n if n else None)
    return out


def _ridge_folds_safe(base: DataFrame, value: str, group: str, vectors: KeyedVectors | None, k: int, alpha: float) -> DataFrame:
    """Leak-free ridge predictions: one aggregate by group, one join, one pass for all fits; the vectors are attached last."""
    with_emb = vectors is not None
    cells = F.sequence(F.lit(0), F.lit(k - 1))
    overall = F.array(*[F.lit(m).cast("double") for m in _split_means(base, value, k)])
    joined = base.join(small_side(split_stats(base, value, group, k)), group, "left")
    joined = joined.withColumns({
        "_ys": F.transform(cells, lambda f: zscore(value, F.col("_means")[f], F.col("_stds")[f])),
        "_avgs": F.transform(cells, lambda f: F.coalesce(F.col("_means")[f], overall[f])),
        "channel_avg_perf": F.lit(0.0)})
    data = feature_columns(joined, keep=("fold", "_ys", "_avgs", *(vectors.on[1:] if with_emb else ())))
    data = attach_vectors(data, vectors, "splits") if with_emb else materialize(data, "splits")
    width, lead = _widths(data, TAB_FEATURES, with_emb)
    at = lead + TAB_FEATURES.index("channel_avg_perf")
    x = tab_array(with_embedding=with_emb)
    used = F.transform(cells, lambda f: (F.col("fold") != f) & finite(F.col("_ys")[f]))
    ys = F.transform("_ys", lambda y: F.coalesce(y, F.lit(0.0)))
    grams = gram.fold_grams(data, k, width, x, ys, used, F.transform("_avgs", lambda a: F.coalesce(a, F.lit(0.0))), at)
    models = [gram.solve_ridge(g, alpha, gram.deviations(g, lead)) for g in grams]
    held = data.withColumns({"y": F.col("_ys")[F.col("fold").cast("int")],
                             "channel_avg_perf": F.col("_avgs")[F.col("fold").cast("int")]})
    return gram.with_predictions(held.where(finite("y")), models, "fold", x).select("video_id", "fold", "y", "prediction")


def cv_metrics(preds: DataFrame, digits: int = 6) -> DataFrame:
    """Per-fold Pearson of prediction and target, with the mean and population std."""
    per_fold = small_side(preds.groupBy("fold").agg(pearson("prediction", "y").alias("corr"),
                                                    F.count(F.lit(1)).alias("n")))
    summary = per_fold.agg(F.avg("corr").alias("mean_corr"), F.stddev_pop("corr").alias("std_corr"))
    both = summary.select(F.struct("mean_corr", "std_corr")).scalar()
    m, s = both["mean_corr"], both["std_corr"]
    return per_fold.select("fold", "n", F.round("corr", digits).alias("corr"),
                           F.round(m, digits).alias("mean_corr"), F.round(s, digits).alias("std_corr"))


def fit_final(df: DataFrame, kind: str = "ridge", label: str = "y", with_embedding: bool = True,
              alpha: float = 1.0) -> PipelineModel:
    """The pipeline of scaler and estimator, fitted on all rows.

    Columns that are constant in training have no weight and stay out of the fit: with
    them Spark would solve the normal equations by iteration, to 1e-6 only.
    """
    n, s = _label_stats(df, label)
    moments = fit_moments(df)
    varying = [c for c in TAB_FEATURES if moments[c][1] > 0] or list(TAB_FEATURES)
    scaler = {c: (moments[c][0], moments[c][1] or 1.0) for c in varying}
    return regression_pipeline(kind, n, s, label, varying, with_embedding, alpha, scaler=scaler).fit(df)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def with_bounds(model: PipelineModel, lo: float, hi: float) -> PipelineModel:
    """The model with its score bounds as a last stage, so that they are saved and loaded with it."""
    return PipelineModel([*model.stages, rescale_stage("prediction", lo, hi)])


def batch_score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Score any table with a model that holds its bounds (``with_bounds``): key, prediction, 0-20 score."""
    return model.transform(df).select("video_id", "prediction", "score_20")


def prediction_bounds(preds: DataFrame, col: str = "prediction", sigmas: float = 3.0) -> tuple[float, float]:
    row = preds.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("s")).first()
    m, s = float(row["m"]), float(row["s"] or 0.0)
    return m - sigmas * s, m + sigmas * s


def top_quartile_classifier(df: DataFrame, label: str = "label", tab_cols: Sequence[str] = TAB_FEATURES,
                            with_embedding: bool = True, seed: int = 42, k: int = 5, max_iter: int = 20,
                            max_depth: int = 3, parallelism: int = 5,
                            vectors: KeyedVectors | None = None) -> tuple[DataFrame, float]:
    """v3: gradient-boosted classifier of the top-quartile label; probability × 20 and ROC-AUC.

    ``vectors`` are attached after the folds are dealt, to rows that do not hold theirs yet (``features.training_rows``).

    Probabilities and AUC are out of fold: each row is scored by the model that has not seen it.
    """
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed)
    data = df.withColumn(label, F.col(label).cast("double")).transform(assign_folds, "video_id", seed, k)
    data = materialize(data, "folds") if vectors is None else attach_vectors(data, vectors, "folds")

    at_once = _fits_at_once(data, _widths(data, tab_cols, with_embedding)[0], parallelism)

    def fit_fold(f: int) -> DataFrame:
        model = Pipeline(stages=[assembler(tab_cols, with_embedding), gbt]).fit(data.where(F.col("fold") != f))
        scored = model.transform(data.where(F.col("fold") == f))
        return scored.select("video_id", label, vector_to_array("probability")[1].alias("probability"))

    scored = materialize(_each_fold(fit_fold, k, at_once), "out_of_fold")
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability",
                                        metricName="areaUnderROC").evaluate(scored)
    out = scored.select("video_id", F.col(label).cast("int").alias("label"), "probability",
                        F.bround(F.col("probability") * 20, 1).alias("score_20"))
    return out, float(auc)


def minmax_scale(df: DataFrame, col: str, top: float = 20.0, out: str = "score_20") -> DataFrame:
    """Min-max map of ``col`` to [0, top] (bounds as scalar subqueries)."""
    b = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    lo, hi = b["lo"], b["hi"]
    scaled = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(col) - lo) / (hi - lo) * top)
    return df.withColumn(out, F.bround(scaled, 1))


def model_path(spark, name: str) -> str:
    from perfscore.session import scratch_path
    return scratch_path(spark, name)


