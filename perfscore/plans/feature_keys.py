"""Driver keys: features, folds, rescaling, quartile label, promotion gate (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions.features import TAB_FEATURES
from perfscore.functions.stats import pearson
from perfscore.operators import features as fe
from perfscore.operators.promote import promote_gate, runs_from_events
from perfscore.plans.common import rule_scored, scored, scored_cte
from perfscore.plans.fixtures import annotations
from perfscore.plans.registry import key
from perfscore.plans.present_keys import SQL_VISION
from perfscore.session import apply_core_conf, materialize
from perfscore.sources.tables import read_table

E = ("f_enriched",)

SQL_TRAIN_COLS = {
    "has_text": "CAST(coalesce(texte_present, false) AS DOUBLE)",
    "text_short": "CAST(coalesce(text_length > 0 AND text_length <= 20, false) AS DOUBLE)",
    "text_medium": "CAST(coalesce(text_length > 20 AND text_length <= 50, false) AS DOUBLE)",
    "text_long": "CAST(coalesce(text_length > 50, false) AS DOUBLE)",
    "one_person": "CAST(coalesce(nb_personnes = 1, false) AS DOUBLE)",
    "two_people": "CAST(coalesce(nb_personnes = 2, false) AS DOUBLE)",
    "many_people": "CAST(coalesce(nb_personnes >= 3, false) AS DOUBLE)",
    "bg_busy": "CAST(coalesce(fond = 'Chargé', false) AS DOUBLE)",
    "bg_blur": "CAST(coalesce(fond = 'Flou', false) AS DOUBLE)",
    "color_neutral": "CAST(coalesce(couleur_dominante = 'Neutre', false) AS DOUBLE)",
    "color_cold": "CAST(coalesce(couleur_dominante = 'Froid', false) AS DOUBLE)",
    "color_warm": "CAST(coalesce(couleur_dominante = 'Chaud', false) AS DOUBLE)",
    "contrast_high": "CAST(coalesce(contraste = 'Élevé', false) AS DOUBLE)",
    "contrast_med": "CAST(coalesce(contraste = 'Moyen', false) AS DOUBLE)",
    "expr_neutral": "CAST(coalesce(expression = 'Neutre', false) AS DOUBLE)",
    "expr_smile": "CAST(coalesce(expression = 'Sourire', false) AS DOUBLE)",
    "face_conf": "CAST(coalesce(face_confidence, 0) AS DOUBLE)",
    "niche_ai": "CAST(coalesce(niche = 'AI/Tech', false) AS DOUBLE)",
    "log_subs": "ln(1 + subscriber_count)",
    "channel_avg_perf": "avg(performance_score) OVER (PARTITION BY channel_name)",
}
ROUND9 = ("log_subs", "channel_avg_perf")
TRAIN_CTE = (f", {scored_cte('niche')}, feats AS (SELECT video_id, "
             + ", ".join(f"{e} AS {n}" for n, e in SQL_TRAIN_COLS.items()) + " FROM scored)")


def _r9(df):
    return df.select(*[F.round(c, 9).alias(c) if c in ROUND9 else F.col(c) for c in df.columns])


def _train(spark, sf_dir):
    return fe.training_features(rule_scored(spark, sf_dir))


@key("features_train", TRAIN_CTE + " SELECT video_id, " + ", ".join(
    f"round({n}, 9) AS {n}" if n in ROUND9 else n for n in TAB_FEATURES) + " FROM feats", E)
def q_features_train(spark, sf_dir):
    return _r9(_train(spark, sf_dir))


SQL_SERVE_COLS = {
    "has_text": "CAST(text_length > 0 AS DOUBLE)",
    "text_short": "CAST(text_length > 0 AND text_length <= 20 AS DOUBLE)",
    "text_medium": "CAST(text_length > 20 AND text_length <= 50 AS DOUBLE)",
    "text_long": "CAST(text_length > 50 AS DOUBLE)",
    "one_person": "CAST(nb_faces = 1 AS DOUBLE)",
    "two_people": "CAST(nb_faces = 2 AS DOUBLE)",
    "many_people": "CAST(nb_faces >= 3 AS DOUBLE)",
    "bg_busy": "CAST(background = 'Chargé' AS DOUBLE)",
    "bg_blur": "0.0e0",
    "color_neutral": "CAST(color = 'Neutre' AS DOUBLE)",
    "color_cold": "CAST(color = 'Froid' AS DOUBLE)",
    "color_warm": "CAST(color = 'Chaud' AS DOUBLE)",
    "contrast_high": "CAST(contrast = 'Élevé' AS DOUBLE)",
    "contrast_med": "CAST(contrast = 'Moyen' AS DOUBLE)",
    "expr_neutral": "CAST(expression = 'Neutre' AS DOUBLE)",
    "expr_smile": "CAST(expression = 'Sourire' AS DOUBLE)",
    "face_conf": "CASE WHEN nb_faces > 0 THEN fc ELSE 0.0e0 END",
    "niche_ai": "1.0e0",
    "log_subs": "round(ln(1 + 100000), 9)",
    "channel_avg_perf": "0.003e0",
}


@key("features_serve", SQL_VISION
     + "SELECT video_id, " + ", ".join(f"{e} AS {n}" for n, e in SQL_SERVE_COLS.items()) + " FROM vis2")
def q_features_serve(spark, sf_dir):
    apply_core_conf(spark)
    return _r9(fe.serving_features(annotations(spark, sf_dir)))


@key("features_serve_cli", SQL_VISION
     + "SELECT video_id, " + ", ".join(
         ("CAST(n_texts > 1 AS DOUBLE)" if n == "has_text" else e) + f" AS {n}" for n, e in SQL_SERVE_COLS.items())
     + " FROM vis2")
def q_features_serve_cli(spark, sf_dir):
    apply_core_conf(spark)
    return _r9(fe.serving_features(annotations(spark, sf_dir), form="cli"))


def scaled_sql(n: str) -> str:
    s = f"stddev_pop({n}) OVER ()"
    return f"round(({n} - avg({n}) OVER ()) / (CASE WHEN {s} = 0 THEN 1 ELSE {s} END), 6) AS {n}"


@key("features_scaled", TRAIN_CTE + " SELECT video_id, " + ", ".join(scaled_sql(n) for n in TAB_FEATURES)
     + " FROM feats", E)
def q_features_scaled(spark, sf_dir):
    feats = materialize(_train(spark, sf_dir), "features")
    scaled = fe.apply_scaler(feats, fe.fit_scaler(feats))
    return scaled.select("video_id", *[F.round(c, 6).alias(c) for c in TAB_FEATURES])


SQL_FOLD = "(row_number() OVER (ORDER BY ('0x' || substr(md5(video_id || '42'), 1, 15))::BIGINT, video_id) - 1) % 5"


@key("fold_assign", f"SELECT video_id, {SQL_FOLD} AS fold FROM f_enriched", E)
def q_fold_assign(spark, sf_dir):
    from perfscore.plans.common import enriched
    return fe.assign_folds(enriched(spark, sf_dir).select("video_id"), "video_id", 42, 5, rows_per_part=1000)


@key("fold_corr", f", {scored_cte('niche')} SELECT fold, count(*) AS n, "
     "CASE WHEN isnan(corr(thumbnail_score, perf_norm)) THEN NULL ELSE round(corr(thumbnail_score, perf_norm), 6) END "
     f"AS corr FROM (SELECT *, {SQL_FOLD} AS fold FROM scored) GROUP BY fold", E)
def q_fold_corr(spark, sf_dir):
    df = fe.assign_folds(scored(spark, sf_dir), "video_id", 42, 5)
    return df.groupBy("fold").agg(F.count(F.lit(1)).alias("n"),
                                  F.round(pearson("thumbnail_score", "perf_norm"), 6).alias("corr"))


def rescale_sql(x: str, lo: str, hi: str) -> str:
    return f"round_even(least(greatest(({x} - {lo}) / ({hi} - {lo}) * 20, 0), 20), 1)"


@key("rescale_3sigma", f", {scored_cte('niche')}, b AS (SELECT avg(thumbnail_score) AS m, "
     "stddev_pop(thumbnail_score) AS s FROM scored) SELECT video_id, "
     + rescale_sql("thumbnail_score", "(m - 3 * s)", "(m + 3 * s)") + " AS score_20 FROM scored, b", E)
def q_rescale_3sigma(spark, sf_dir):
    return fe.rescale_3sigma(scored(spark, sf_dir), "thumbnail_score").select("video_id", "score_20")


@key("rescale_fixed", f", {scored_cte('niche')} SELECT video_id, "
     + rescale_sql("perf_norm", f"({fe.MODEL_SCORE_MIN})", f"({fe.MODEL_SCORE_MAX})") + " AS score_20 FROM scored", E)
def q_rescale_fixed(spark, sf_dir):
    return fe.rescale_fixed(scored(spark, sf_dir), "perf_norm").select("video_id", "score_20")


@key("top_quartile_label", f", {scored_cte('niche')}, t AS (SELECT quantile_cont(performance_score, 0.75) AS q "
     "FROM scored) SELECT video_id, CAST(performance_score >= q AS INT) AS label FROM scored, t", E)
def q_top_quartile(spark, sf_dir):
    return fe.top_quantile_label(scored(spark, sf_dir), "performance_score").select("video_id", "label")


PROMOTE_SQL = """WITH RECURSIVE runs AS (
  SELECT event_type AS segment, CAST(ts AS DATE) AS run_day, avg(value) / 100 AS metric FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY run_day) AS rn FROM runs),
g(segment, rn, run_day, metric, promoted, champion) AS (
  SELECT segment, rn, run_day, metric, metric > 0.0e0 + 0.005, CASE WHEN metric > 0.0e0 + 0.005 THEN metric ELSE 0.0e0 END
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.segment, r.rn, r.run_day, r.metric, r.metric > g.champion + 0.005,
         CASE WHEN r.metric > g.champion + 0.005 THEN r.metric ELSE g.champion END
  FROM g JOIN r ON r.segment = g.segment AND r.rn = g.rn + 1)
SELECT segment, run_day, round(metric, 6) AS metric, promoted, round(champion, 6) AS champion,
       CASE WHEN promoted THEN strftime(run_day, '%Y%m%d') END AS version FROM g"""


@key("promote_gate", PROMOTE_SQL)
def q_promote_gate(spark, sf_dir):
    apply_core_conf(spark)
    runs = runs_from_events(read_table(spark, sf_dir, "events"))
    out = promote_gate(runs)
    return out.select("segment", "run_day", F.round("metric", 6).alias("metric"), "promoted",
                      F.round("champion", 6).alias("champion"), "version")
