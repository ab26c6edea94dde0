"""Driver keys: video measures, rule score, within-group statistics (B9-B11, E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions.features import analysis_flags
from perfscore.functions.video import (MIN_VIEWS, as_of_literal, is_short,
                                       performance_score, views_per_sub)
from perfscore.operators import stats as st
from perfscore.operators.scoring import with_performance, with_rule_score
from perfscore.plans.common import (SQL_PERF, SQL_SCORE, SQL_TEXT_LEN, enriched,
                                    scored, scored_cte, sql_corr, videos_raw)
from perfscore.plans.fixtures import AS_OF
from perfscore.plans.registry import key

V = ("f_videos_raw",)
E = ("f_enriched",)


@key("is_short", "SELECT video_id, CASE WHEN duration LIKE '%H%' THEN false "
     "WHEN duration NOT LIKE '%M%' THEN coalesce(try_cast(replace(replace(duration, 'PT', ''), 'S', '') AS INT) < 60, false) "
     "ELSE coalesce(try_cast(replace(split_part(duration, 'M', 1), 'PT', '') AS INT) = 0, false) END AS is_short "
     "FROM f_videos_raw", V)
def q_is_short(spark, sf_dir):
    return videos_raw(spark, sf_dir).select("video_id", is_short("duration").alias("is_short"))


@key("performance_score", f"SELECT video_id, {SQL_PERF} AS performance_score FROM f_videos_raw", V)
def q_performance_score(spark, sf_dir):
    v = videos_raw(spark, sf_dir)
    return v.select("video_id", performance_score("view_count", "published_at", "subscriber_count",
                                                  as_of_literal(AS_OF)).alias("performance_score"))


@key("views_per_sub", "SELECT video_id, view_count / greatest(subscriber_count, 1) AS views_per_sub "
     "FROM f_videos_raw", V)
def q_views_per_sub(spark, sf_dir):
    v = videos_raw(spark, sf_dir)
    return v.select("video_id", views_per_sub("view_count", "subscriber_count").alias("views_per_sub"))


@key("min_views_filter", f"SELECT video_id, view_count FROM f_videos_raw WHERE view_count >= {MIN_VIEWS}", V)
def q_min_views(spark, sf_dir):
    v = videos_raw(spark, sf_dir)
    return v.where(F.col("view_count") >= MIN_VIEWS).select("video_id", "view_count")


@key("text_length", f"SELECT video_id, {SQL_TEXT_LEN} AS text_length FROM f_enriched_left",
     ("f_enriched_left",))
def q_text_length(spark, sf_dir):
    from perfscore.functions.scoring import text_length
    return enriched(spark, sf_dir, left=True).select("video_id", text_length().alias("text_length"))


@key("score_v5", f"SELECT video_id, {SQL_SCORE} AS thumbnail_score FROM f_enriched", E)
def q_score_v5(spark, sf_dir):
    return with_rule_score(enriched(spark, sf_dir)).select("video_id", "thumbnail_score")


def _z_oracle(group: str) -> str:
    return f", {scored_cte(group)} SELECT video_id, round(perf_norm, 6) AS z FROM scored"


@key("zscore_within_niche", _z_oracle("niche"), E)
def q_z_niche(spark, sf_dir):
    return scored(spark, sf_dir, "niche").select("video_id", F.round("perf_norm", 6).alias("z"))


@key("zscore_within_channel", _z_oracle("channel_name"), E)
def q_z_channel(spark, sf_dir):
    return scored(spark, sf_dir, "channel_name").select("video_id", F.round("perf_norm", 6).alias("z"))


@key("group_mean", f", s AS (SELECT *, {SQL_PERF} AS performance_score FROM f_enriched) "
     "SELECT video_id, round(avg(performance_score) OVER (PARTITION BY channel_name), 9) AS channel_avg_perf FROM s", E)
def q_group_mean(spark, sf_dir):
    df = with_performance(enriched(spark, sf_dir), AS_OF)
    out = st.group_mean(df, "performance_score", "channel_name", out="channel_avg_perf")
    return out.select("video_id", F.round("channel_avg_perf", 9).alias("channel_avg_perf"))


@key("pearson_pair", f", {scored_cte('niche')} "
     f"SELECT 'raw' AS target, {sql_corr('thumbnail_score', 'performance_score')} AS corr FROM scored "
     f"UNION ALL SELECT 'within_group', {sql_corr('thumbnail_score', 'perf_norm')} FROM scored", E)
def q_pearson_pair(spark, sf_dir):
    return st.pearson_pair(scored(spark, sf_dir), "thumbnail_score", "performance_score", "perf_norm")


@key("score_bands_v5", f", {scored_cte('niche')}, b AS (SELECT CASE "
     "WHEN thumbnail_score >= 0 AND thumbnail_score < 5 THEN '0-5' "
     "WHEN thumbnail_score >= 5 AND thumbnail_score < 10 THEN '5-10' "
     "WHEN thumbnail_score >= 10 AND thumbnail_score < 15 THEN '10-15' "
     "WHEN thumbnail_score >= 15 AND thumbnail_score < 20 THEN '15-20' END AS band, perf_norm FROM scored) "
     "SELECT band, count(*) AS n, round(avg(perf_norm), 6) AS mean_z FROM b WHERE band IS NOT NULL GROUP BY band", E)
def q_score_bands(spark, sf_dir):
    return st.score_bands(scored(spark, sf_dir), "thumbnail_score", "perf_norm")


@key("score_summary", f", {scored_cte('niche')} SELECT min(thumbnail_score) AS min_score, "
     "max(thumbnail_score) AS max_score, round(avg(thumbnail_score), 6) AS mean_score, "
     "round(median(thumbnail_score), 6) AS median_score FROM scored", E)
def q_score_summary(spark, sf_dir):
    return st.score_summary(scored(spark, sf_dir), "thumbnail_score")


# Flag conditions in SQL, in the same order as analysis_flags().
SQL_FLAGS = {
    "has_text": "coalesce(texte_present, false)",
    "text_short": "text_length > 0 AND text_length <= 20",
    "text_medium": "text_length > 20 AND text_length <= 50",
    "text_long": "text_length > 50",
    "one_person": "nb_personnes = 1",
    "two_people": "nb_personnes = 2",
    "many_people": "nb_personnes >= 3",
    "bg_busy": "fond = 'Chargé'",
    "bg_blur": "fond = 'Flou'",
    "color_neutral": "couleur_dominante = 'Neutre'",
    "color_cold": "couleur_dominante = 'Froid'",
    "color_warm": "couleur_dominante = 'Chaud'",
    "contrast_high": "contraste = 'Élevé'",
    "contrast_med": "contraste = 'Moyen'",
    "expr_neutral": "expression = 'Neutre'",
    "expr_smile": "expression = 'Sourire'",
    "face": "coalesce(visage_present, false)",
    "contrast_low": "contraste = 'Faible'",
}


def _flag_union(value: str, expr: str, alias: str) -> str:
    parts = []
    for name, cond in SQL_FLAGS.items():
        on = f"coalesce({cond}, false)"
        mw = f"avg(CASE WHEN {on} THEN {value} END)"
        mo = f"avg(CASE WHEN NOT {on} THEN {value} END)"
        parts.append(f"SELECT '{name}' AS feature, count(*) FILTER (WHERE {on}) AS n_with, "
                     f"{expr.format(mw=mw, mo=mo)} AS {alias} FROM scored")
    return " UNION ALL ".join(parts)


RAW_LIFT_SQL = "CASE WHEN {mo} = 0 THEN NULL ELSE {mw} / {mo} END"
RAW_DIFF_SQL = "{mw} - {mo}"
LIFT_SQL = f"round({RAW_LIFT_SQL}, 6)"
DIFF_SQL = f"round({RAW_DIFF_SQL}, 6)"


@key("feature_lift", f", {scored_cte('niche')} " + _flag_union("performance_score", LIFT_SQL, "lift"), E)
def q_feature_lift(spark, sf_dir):
    return st.feature_lift(scored(spark, sf_dir), analysis_flags(), "performance_score")


@key("feature_diff_within", f", {scored_cte('niche')} " + _flag_union("perf_norm", DIFF_SQL, "diff"), E)
def q_feature_diff(spark, sf_dir):
    return st.feature_diff(scored(spark, sf_dir), analysis_flags(), "perf_norm")


@key("confound_flips", f", {scored_cte('niche')}, l AS ({_flag_union('performance_score', RAW_LIFT_SQL, 'lift')}), "
     f"d AS ({_flag_union('perf_norm', RAW_DIFF_SQL, 'diff')}) "
     "SELECT l.feature, round(l.lift, 6) AS lift, round(d.diff, 6) AS diff, (l.lift > 1) <> (d.diff > 0) AS flipped "
     "FROM l JOIN d ON l.feature = d.feature", E)
def q_confound(spark, sf_dir):
    return st.confound_flips(scored(spark, sf_dir), analysis_flags(), "performance_score", "perf_norm")


@key("top_scored", f", {scored_cte('niche')} SELECT video_id, "
     "CASE WHEN length(title) > 38 THEN substr(title, 1, 38) || '..' ELSE title END AS title, "
     "channel_name, thumbnail_score, round(perf_norm, 6) AS perf_norm, performance_score FROM scored "
     "ORDER BY thumbnail_score DESC, video_id LIMIT 10", E)
def q_top_scored(spark, sf_dir):
    top = st.top_k(scored(spark, sf_dir), "thumbnail_score", 10)
    return top.select("video_id", st.shorten("title", 38, "..").alias("title"), "channel_name",
                      "thumbnail_score", F.round("perf_norm", 6).alias("perf_norm"), "performance_score")
