"""Driver keys: model fits.  Ridge fits have an oracle (Gauss elimination in SQL); tree fits have none."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from perfscore.functions.features import TAB_FEATURES, analysis_flags
from perfscore.operators import features as fe
from perfscore.operators import models as md
from perfscore.operators import present as pr
from perfscore.operators import stats as st
from perfscore.plans.common import rule_scored, scored_cte, videos_raw
from perfscore.plans.feature_keys import SQL_FOLD, SQL_SERVE_COLS, SQL_TRAIN_COLS, rescale_sql, scaled_sql
from perfscore.plans.fixtures import annotations
from perfscore.plans.present_keys import SQL_VISION, result_json_sql
from perfscore.plans.registry import key
from perfscore.plans.scoring_keys import RAW_DIFF_SQL, _flag_union
from perfscore.sources.embeddings import embedding_table
from perfscore.session import materialize
from perfscore.sources.tables import read_table


SQL_EMB = ("JOIN embeddings e ON e.vec_id = CAST(f_enriched.video_id AS BIGINT) % (2 * (SELECT count(*) FROM embeddings)) "
           "AND e.embedding IS NOT NULL")


def _emb(spark, sf_dir, only=None):
    """One vector per video (of those that are asked for), lent from the embeddings table; every other run of videos has none."""
    emb = embedding_table(read_table(spark, sf_dir, "embeddings"))
    n = emb.select(F.count(F.lit(1))).scalar()
    videos = videos_raw(spark, sf_dir).select("video_id")
    if only is not None:
        videos = videos.join(only.select("video_id"), "video_id", "left_semi")
    videos = videos.select(F.col("video_id").alias("id"))
    lent = videos.withColumn("video_id", (F.col("id").cast("bigint") % (2 * n)).cast("string"))
    return lent.join(emb, "video_id").drop("video_id").withColumnRenamed("id", "video_id")


def _rows(spark, sf_dir):
    """The scored rows as far as the models and reports read them, written once: statistics and rows are made of them."""
    return materialize(rule_scored(spark, sf_dir).select(
        "video_id", "channel_name", "niche", "subscriber_count", "performance_score", "text_length", "texte_present",
        "visage_present", "nb_personnes", "expression", "couleur_dominante", "contraste", "fond", "face_confidence"), "rows")


def _training(spark, sf_dir, with_embedding=True, keep=(), written=None):
    emb = _emb(spark, sf_dir) if with_embedding else None
    return fe.training_input(_rows(spark, sf_dir), emb, keep=keep, written=written)


def _out_of_fold(spark, sf_dir):
    """Ridge predictions; the vectors are attached to rows that have their target and fold."""
    vectors = fe.keyed_vectors(_emb(spark, sf_dir))
    return md.cross_val_predictions(fe.training_rows(_rows(spark, sf_dir), vectors), "ridge", vectors=vectors)


def _input_sql() -> str:
    cols = dict(SQL_TRAIN_COLS, channel_avg_perf="avg(performance_score) OVER (PARTITION BY channel_name)")
    scored = (f", {scored_cte('channel_name')}".replace("FROM f_enriched)", f"FROM f_enriched {SQL_EMB})")
              .replace("SELECT *, view_count", "SELECT f_enriched.*, view_count"))
    feats = ", ".join(f"{e} AS {n}" for n, e in cols.items())
    return (f"{scored}, feats AS (SELECT video_id, perf_norm AS y, {feats} FROM scored), "
            "used AS (SELECT * FROM feats WHERE y IS NOT NULL AND NOT isnan(y)) SELECT video_id, round(y, 6) AS y, "
            + ", ".join(scaled_sql(n) for n in TAB_FEATURES) + " FROM used")


@key("training_input", _input_sql(), ("f_enriched",))
def q_training_input(spark, sf_dir):
    """What the models see: rows with an embedding, their target by channel, their scaled features."""
    data = _training(spark, sf_dir, written="training_input")
    scaled = fe.apply_scaler(data, fe.fit_scaler(data))
    return scaled.select("video_id", F.round("y", 6).alias("y"), *[F.round(c, 6).alias(c) for c in TAB_FEATURES])


def ridge_cte(alpha: float, width: int, lead: int, scaled_by: str) -> str:
    """CTEs that fit a ridge per split ``f`` by Gauss elimination: ``fit(f, b, w, ws)``.

    They read ``r(f, held, x, y)``, inputs as a list of ``width`` doubles.  Inputs after the first ``lead`` are divided by
    their deviation over the rows that ``scaled_by`` names; ``ws`` are the weights of the divided inputs.
    """
    n = width + 1
    return f"""
ij AS (SELECT i, j FROM (SELECT unnest(range(1, {n + 2})) AS i), (SELECT unnest(range(1, {n + 2})) AS j) WHERE i <= j),
half AS (SELECT f, i, j, sum(a[i] * a[j]) AS g FROM (SELECT f, list_concat([1.0::DOUBLE], x, [y]) AS a FROM r WHERE NOT held), ij
         GROUP BY f, i, j),
gram AS (SELECT f, i, j, g FROM half UNION ALL SELECT f, j, i, g FROM half WHERE i <> j),
mean AS (SELECT a.f, a.j, a.g / b.g AS m, b.g AS n FROM gram a JOIN gram b ON a.f = b.f AND b.i = 1 AND b.j = 1 WHERE a.i = 1),
dev AS (SELECT f, j, CASE WHEN j <= {lead + 1} OR s = 0 OR j > {n} THEN 1 ELSE s END AS s
        FROM (SELECT f, j, stddev_pop(CASE WHEN j = 1 THEN 1 WHEN j <= {n} THEN x[j - 1] END) AS s
              FROM (SELECT f, x FROM r WHERE {scaled_by}), (SELECT unnest(range(2, {n + 2})) AS j) GROUP BY f, j)),
inner_ AS (SELECT g.f, g.i, g.j, (g.g - p.n * p.m * q.m) / d.s / e.s + CASE WHEN g.i = g.j THEN {alpha} ELSE 0 END AS v
           FROM gram g JOIN mean p ON p.f = g.f AND p.j = g.i JOIN mean q ON q.f = g.f AND q.j = g.j
           JOIN dev d ON d.f = g.f AND d.j = g.i JOIN dev e ON e.f = g.f AND e.j = g.j WHERE g.i > 1 AND g.i <= {n} AND g.j > 1),
el AS (SELECT f, 1 AS k, list(v ORDER BY i) AS m FROM (SELECT f, i, list(v ORDER BY j) AS v FROM inner_ GROUP BY f, i) GROUP BY f
       UNION ALL SELECT f, k + 1, list_transform(m, lambda row, i: CASE WHEN i = k THEN pv
           ELSE list_transform(row, lambda v, c: v - row[k] * pv[c]) END)
       FROM (SELECT f, k, m, list_transform(m[k], lambda v: v / m[k][k]) AS pv FROM el WHERE k <= {width})),
solved AS (SELECT f, j, m[j - 1][{n}] AS ws, m[j - 1][{n}] / s AS w FROM el JOIN dev USING (f) WHERE k = {n} AND j <= {n}),
fit AS (SELECT f, any_value(y.m) - sum(w * x.m) AS b, list(w ORDER BY j) AS w, list(ws ORDER BY j) AS ws
        FROM solved JOIN mean x USING (f, j) JOIN mean y USING (f) WHERE y.j = {n + 1} GROUP BY f)"""


TAB_LIST = "[" + ", ".join(TAB_FEATURES) + "]"
EMB_DIM = 64    # width of the driver's embedding table
SPLITS = "(SELECT unnest(range(0, 5)) AS f)"


def _feats_sql(embedding: bool, avg: str, cols: str) -> str:
    """CTE ``feats``: the 20 features of all scored rows, ``avg`` as the group mean, and further columns."""
    own = dict(SQL_TRAIN_COLS, channel_avg_perf=avg)
    scored = f", {scored_cte('channel_name')}"
    if embedding:
        scored = (scored.replace("FROM f_enriched)", f"FROM f_enriched {SQL_EMB})")
                  .replace("SELECT *, view_count", "SELECT f_enriched.*, e.embedding, view_count"))
    return (f"{scored}, feats AS (SELECT video_id, " + ", ".join(f"{e} AS {n}" for n, e in own.items()) + f", {cols} FROM scored)")


_CV_SQL = (_feats_sql(True, "avg(performance_score) OVER (PARTITION BY channel_name)", "embedding, perf_norm AS y")
           + ", used AS (SELECT * FROM feats WHERE y IS NOT NULL AND NOT isnan(y)), "
           f"folded AS (SELECT video_id, {SQL_FOLD} AS fold, list_concat(embedding::DOUBLE[], {TAB_LIST}) AS x, y FROM used), "
           f"r AS (SELECT *, fold = f AS held FROM folded, {SPLITS}), " + ridge_cte(1.0, EMB_DIM + len(TAB_FEATURES), EMB_DIM, "true")
           + " SELECT video_id, fold, round(y, 6) AS y, round(b + list_dot_product(w, x), 6) AS prediction FROM r JOIN fit USING (f) WHERE held")


@key("cv_predictions", _CV_SQL, ("f_enriched",))
def q_cv_predictions(spark, sf_dir):
    """Out-of-fold ridge predictions; the oracle solves each fold's normal equations."""
    preds = _out_of_fold(spark, sf_dir)
    return preds.select("video_id", "fold", F.round("y", 6).alias("y"), F.round("prediction", 6).alias("prediction"))


@key("cv_predictions_gbt")
def q_cv_predictions_gbt(spark, sf_dir):
    preds = md.cross_val_predictions(_training(spark, sf_dir, with_embedding=False), "gbt",
                                     with_embedding=False)
    return preds.select("video_id", "fold", "y", F.round("prediction", 6).alias("prediction"))


_SAFE_SQL = (_feats_sql(True, "0.0::DOUBLE", f"embedding, channel_name, performance_score AS v, {SQL_FOLD} AS fold")
             + f", stat AS (SELECT f, channel_name, avg(v) AS m, stddev_samp(v) AS s FROM feats, {SPLITS} "
             "WHERE fold <> f GROUP BY f, channel_name), "
             f"r AS (SELECT f, fold = f AS held, video_id, fold, list_concat(embedding::DOUBLE[], "
             f"{TAB_LIST.replace('channel_avg_perf', 'm')}) AS x, (v - m) / (s + 1e-9) AS y "
             f"FROM (SELECT * FROM feats, {SPLITS}) JOIN stat USING (f, channel_name) WHERE s IS NOT NULL AND NOT isnan(s)), "
             + ridge_cte(1.0, EMB_DIM + len(TAB_FEATURES), EMB_DIM, "NOT held")
             + " SELECT video_id, fold, round(y, 6) AS y, round(b + list_dot_product(w, x), 6) AS prediction FROM r JOIN fit USING (f) WHERE held")


@key("cv_predictions_fold_safe", _SAFE_SQL, ("f_enriched",))
def q_cv_predictions_fold_safe(spark, sf_dir):
    """Target, group mean and scaler fitted inside each training split."""
    preds = md.cross_val_predictions_fold_safe(_rows(spark, sf_dir), _emb(spark, sf_dir))
    return preds.select("video_id", "fold", F.round("y", 6).alias("y"),
                        F.round("prediction", 6).alias("prediction"))


@key("cv_metrics", _CV_SQL.replace(" SELECT video_id, fold, round(y, 6) AS y, round(b + list_dot_product(w, x), 6) AS prediction", ", "
     "p AS (SELECT fold, y, b + list_dot_product(w, x) AS p") + "), c AS (SELECT fold, count(*) AS n, corr(p, y) AS c FROM p GROUP BY fold) "
     "SELECT fold, n, round(c, 6) AS corr, round(avg(c) OVER (), 6) AS mean_corr, round(stddev_pop(c) OVER (), 6) AS std_corr FROM c",
     ("f_enriched",))
def q_cv_metrics(spark, sf_dir):
    return md.cv_metrics(_out_of_fold(spark, sf_dir))


_WEIGHTS_SQL = (_feats_sql(False, "avg(performance_score) OVER (PARTITION BY channel_name)", "perf_norm AS y")
                + f", r AS (SELECT 0 AS f, false AS held, {TAB_LIST} AS x, y FROM feats WHERE y IS NOT NULL AND NOT isnan(y)), "
                + ridge_cte(md.RIDGE_ALPHA, len(TAB_FEATURES), 0, "true")
                + f" SELECT unnest({list(TAB_FEATURES)}) AS feature, round(unnest(ws), 6) AS weight FROM fit")


@key("ridge_weights", _WEIGHTS_SQL, ("f_enriched",))
def q_ridge_weights(spark, sf_dir):
    """Ridge weights of the standardised features; the oracle solves the normal equations."""
    return _ridge_weights(_rows(spark, sf_dir))


def _ridge_weights(rows):
    data = materialize(fe.training_input(rows), "training")
    scaled = fe.apply_scaler(data, fe.fit_scaler(data))
    return md.ridge_weights(scaled).select("feature", F.round("weight", 6).alias("weight"))


_BOTH_SQL = (_WEIGHTS_SQL.replace(" SELECT unnest(", ", ridge AS (SELECT unnest(", 1) + f"), diffs AS ({_flag_union('perf_norm', RAW_DIFF_SQL, 'diff')}) "
             "SELECT feature, round(diff, 6) AS diff, weight FROM diffs JOIN ridge USING (feature) WHERE diff > 0 AND weight > 0")


@key("positive_in_both", _BOTH_SQL, ("f_enriched",))
def q_positive_in_both(spark, sf_dir):
    """Features with a positive mean difference within channels and a positive ridge weight."""
    rows = _rows(spark, sf_dir)
    scored = st.zscore_within(rows, "performance_score", "channel_name", out="perf_norm")
    diff = st.feature_diff(scored, analysis_flags(), "perf_norm", digits=None)
    both = st.positive_in_both(diff, _ridge_weights(rows))
    return both.select("feature", F.round("diff", 6).alias("diff"), "weight")


def _final(spark, sf_dir):
    """Training rows and the final ridge model with its bounds, saved and loaded again."""
    data = _training(spark, sf_dir, keep=("channel_name", "performance_score"), written="training")
    model = md.fit_final(data, "ridge")
    lo, hi = md.prediction_bounds(model.transform(data))
    path = md.save_model(md.with_bounds(model, lo, hi), md.model_path(spark, "ridge_model"))
    return data, md.load_model(path)


_FINAL_SQL = (_feats_sql(True, "avg(performance_score) OVER (PARTITION BY channel_name)",
                         "embedding, perf_norm AS y, channel_name, performance_score")
              + f", used AS (SELECT *, list_concat(embedding::DOUBLE[], {TAB_LIST}) AS x FROM feats WHERE y IS NOT NULL AND NOT isnan(y)), "
              "r AS (SELECT 0 AS f, false AS held, x, y FROM used), " + ridge_cte(1.0, EMB_DIM + len(TAB_FEATURES), EMB_DIM, "true")
              + ", bounds AS (SELECT avg(p) - 3 * stddev_pop(p) AS lo, avg(p) + 3 * stddev_pop(p) AS hi "
              "FROM (SELECT b + list_dot_product(w, x) AS p FROM used, fit))")


@key("scored_table", _FINAL_SQL + " SELECT video_id, channel_name, " + rescale_sql("(b + list_dot_product(w, x))", "lo", "hi")
     + " AS thumbnail_score_nn, round(y, 6) AS perf_norm, performance_score FROM used, fit, bounds", ("f_enriched",))
def q_scored_table(spark, sf_dir):
    """The model's scores of all training rows, written as a table and read again."""
    data, model = _final(spark, sf_dir)
    out = model.transform(data).select(
        "video_id", "channel_name", F.col("score_20").alias("thumbnail_score_nn"),
        F.round("y", 6).alias("perf_norm"), "performance_score")
    path = md.model_path(spark, "scored_nn")
    out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SERVED = dict(SQL_SERVE_COLS, log_subs="ln(1 + 100000)")
_REQUEST_SQL = (_FINAL_SQL + ", " + SQL_VISION.removeprefix("WITH ").rstrip()
                + ", requests AS (SELECT vis2.*, list_concat(e.embedding::DOUBLE[], ["
                + ", ".join(_SERVED[n] for n in TAB_FEATURES) + "]) AS inputs FROM vis2 JOIN f_videos_raw USING (video_id) "
                + SQL_EMB.replace("f_enriched.video_id", "video_id")
                + "), served AS (SELECT *, " + rescale_sql("prediction", "lo", "hi") + " AS score_20 FROM "
                "(SELECT requests.*, fit.b + list_dot_product(fit.w, inputs) AS prediction FROM requests, fit), bounds)")


def _served(spark, sf_dir):
    """Predictions and scores of the serving features of raw annotations, by the loaded model."""
    _, model = _final(spark, sf_dir)
    vectors = _emb(spark, sf_dir, only=annotations(spark, sf_dir))
    requests = fe.serving_features(annotations(spark, sf_dir)).join(vectors.select("video_id", "embedding"), "video_id")
    return md.batch_score(model, requests.withColumn("emb", array_to_vector("embedding")).drop("embedding"))


@key("batch_score", _REQUEST_SQL + " SELECT video_id, round(prediction, 6) AS prediction, score_20 FROM served",
     ("f_enriched", "f_videos_raw"))
def q_batch_score(spark, sf_dir):
    """Fit, save, load, then score the serving feature table of raw annotations."""
    return _served(spark, sf_dir).select("video_id", F.round("prediction", 6).alias("prediction"), "score_20")


@key("model_result_json", _REQUEST_SQL + " SELECT video_id, " + result_json_sql("score_20") + " AS json FROM served",
     ("f_enriched", "f_videos_raw"))
def q_model_result_json(spark, sf_dir):
    """The nested result of the serving path: the model's score over the rule's breakdown."""
    vision = pr.serving_vision(annotations(spark, sf_dir)).join(_served(spark, sf_dir), "video_id")
    return pr.result_json(pr.score_result(vision, F.col("score_20")))


_V2_SQL = (f", {scored_cte('channel_name')}, feats AS (SELECT video_id, ln(performance_score) AS y, "
           + ", ".join(f"{e} AS {n}" for n, e in SQL_TRAIN_COLS.items()) + " FROM scored WHERE performance_score > 0), "
           f"used AS (SELECT video_id, {TAB_LIST} AS x, y FROM feats), r AS (SELECT 0 AS f, false AS held, x, y FROM used), "
           + ridge_cte(1.0, len(TAB_FEATURES), 0, "true")
           + ", p AS (SELECT video_id, b + list_dot_product(w, x) AS prediction FROM used, fit) "
           "SELECT video_id, round(prediction, 6) AS prediction, round_even((prediction - min(prediction) OVER ()) / "
           "(max(prediction) OVER () - min(prediction) OVER ()) * 20, 1) AS score_20 FROM p")


@key("ridge_log_v2", _V2_SQL, ("f_enriched",))
def q_ridge_log_v2(spark, sf_dir):
    """v2: ridge on the logarithm of positive performance, predictions mapped to 0-20 by their range."""
    rows = fe.group_mean(rule_scored(spark, sf_dir).where(F.col("performance_score") > 0), "performance_score",
                         "channel_name", out="channel_avg_perf")
    data = materialize(fe.feature_columns(rows.withColumn("y", F.ln("performance_score")), keep=("y",)), "training")
    model = md.fit_final(data, "ridge", with_embedding=False, alpha=1.0)
    preds = model.transform(data).select("video_id", "prediction")
    return md.minmax_scale(preds, "prediction").select(
        "video_id", F.round("prediction", 6).alias("prediction"), "score_20")


@key("gbt_v3")
def q_gbt_v3(spark, sf_dir):
    labelled = fe.top_quantile_label(_rows(spark, sf_dir), "performance_score")
    vectors = fe.keyed_vectors(_emb(spark, sf_dir))
    data = fe.training_rows(labelled, vectors, keep=("label",))
    out, auc = md.top_quartile_classifier(data, vectors=vectors)
    return out.select("video_id", "label", F.round("probability", 6).alias("probability"), "score_20",
                      F.lit(round(auc, 6)).alias("roc_auc"))
