"""Driver keys: merge/enrichment joins (D) and score presentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions.features import analysis_flags
from perfscore.functions.scoring import score_label
from perfscore.operators import enrich as en
from perfscore.operators import present as pr
from perfscore.operators import stats as st
from perfscore.plans import page_fixtures as pf
from perfscore.plans.common import enriched, scored, scored_cte, videos_raw
from perfscore.plans.fixtures import annotations, fixture
from perfscore.plans.label_keys import (SQL_BACKGROUND, SQL_COLOR, SQL_CONTRAST, SQL_EXPR_SERVE, _A)
from perfscore.plans.registry import key
from perfscore.plans.scoring_keys import RAW_LIFT_SQL, _flag_union
from perfscore.session import apply_core_conf
from perfscore.sources.embeddings import embedding_table
from perfscore.sources.tables import read_table

E = ("f_enriched",)
LABEL_COLS = ("visage_present", "texte_present", "nb_personnes", "expression", "texte_contenu",
              "couleur_dominante", "contraste", "fond", "face_confidence")


def _embeddings(spark, sf_dir):
    return embedding_table(read_table(spark, sf_dir, "embeddings"))


@key("merge_labels", "SELECT v.video_id, v.channel_id, " + ", ".join(f"l.{c}" for c in LABEL_COLS)
     + " FROM f_videos_raw v LEFT JOIN f_labels l ON v.video_id = l.video_id", ("f_videos_raw", "f_labels"))
def q_merge_labels(spark, sf_dir):
    apply_core_conf(spark)
    v = videos_raw(spark, sf_dir).select("video_id", "channel_id")
    labels = fixture(spark, sf_dir, "f_labels")
    return en.merge_labels(v, labels, "left").select("video_id", "channel_id", *LABEL_COLS)


@key("semi_embedding", "SELECT video_id, title FROM f_enriched WHERE video_id IN "
     "(SELECT CAST(vec_id AS VARCHAR) FROM embeddings)", E)
def q_semi_embedding(spark, sf_dir):
    return en.keep_with_embedding(enriched(spark, sf_dir), _embeddings(spark, sf_dir)).select("video_id", "title")


@key("join_embedding", "SELECT video_id, CAST(len(e.embedding) AS INT) AS dim, e.label FROM f_enriched f "
     "JOIN embeddings e ON f.video_id = CAST(e.vec_id AS VARCHAR)", E)
def q_join_embedding(spark, sf_dir):
    out = en.attach_embedding(enriched(spark, sf_dir).select("video_id"), _embeddings(spark, sf_dir))
    return out.select("video_id", "dim", "label")


@key("missing_assets", ", img AS (SELECT video_id FROM f_videos_raw WHERE thumbnail_path IS NOT NULL), "
     "m AS (SELECT video_id FROM f_enriched WHERE video_id NOT IN (SELECT video_id FROM img)) "
     "SELECT video_id, (SELECT count(*) FROM m) AS n_missing, (SELECT count(*) FROM f_enriched) AS n_videos, "
     "(SELECT count(*) FROM img) AS n_images FROM m ORDER BY video_id LIMIT 10", E)
def q_missing_assets(spark, sf_dir):
    return en.missing_assets(enriched(spark, sf_dir), pf.image_files(spark, sf_dir), 10)


@key("scoring_defaults", "SELECT video_id, coalesce(CASE WHEN visage_present IS NULL THEN NULL ELSE subscriber_count END, "
     "100000) AS subscriber_count, coalesce(NULL, 0.003e0) AS channel_avg_perf, "
     "coalesce(CASE WHEN CAST(channel_id AS BIGINT) % 2 = 0 THEN NULL ELSE niche END, 'AI/Tech') AS niche "
     "FROM f_enriched_left", ("f_enriched_left",))
def q_scoring_defaults(spark, sf_dir):
    df = enriched(spark, sf_dir, left=True)
    req = df.select("video_id",
                    F.when(F.col("visage_present").isNotNull(), F.col("subscriber_count")).alias("subscriber_count"),
                    F.lit(None).cast("double").alias("channel_avg_perf"),
                    F.when(F.col("channel_id").cast("bigint") % 2 != 0, F.col("niche")).alias("niche"))
    return en.scoring_defaults(req)


SQL_VISION = _A + """, vis AS (SELECT video_id,
   CASE WHEN n_texts > 0 THEN coalesce(substr(text, 1, 200), '') ELSE '' END AS text_content,
   n_faces AS nb_faces, {expr} AS expression, {color} AS color, {bg} AS background, {ct} AS contrast,
   round_even(CASE WHEN n_faces > 0 THEN face_conf ELSE 0.0e0 END, 3) AS face_conf,
   face_conf AS fc, n_texts FROM c),
vis2 AS (SELECT *, length(text_content) AS text_length FROM vis),
dims AS (
 SELECT video_id, 'text' AS dimension, CASE WHEN text_length > 0 THEN (CASE WHEN text_length > 50 THEN 10.0e0
        WHEN text_length > 20 THEN 8.5e0 ELSE 7.0e0 END) ELSE 0.0e0 END AS score, 10 AS max, text_content AS value FROM vis2
 UNION ALL SELECT video_id, 'face', CASE WHEN nb_faces = 1 THEN 4.0e0 WHEN nb_faces = 2 THEN 2.0e0 ELSE 0.0e0 END,
        4, CAST(nb_faces AS VARCHAR) FROM vis2
 UNION ALL SELECT video_id, 'expression', CASE WHEN expression = 'Neutre' THEN 3.0e0 WHEN expression = 'Sourire'
        THEN 2.5e0 ELSE 0.0e0 END, 3, expression FROM vis2
 UNION ALL SELECT video_id, 'colors', CASE WHEN color = 'Froid' THEN 3.0e0 WHEN color = 'Neutre' THEN 1.5e0
        ELSE 0.0e0 END, 3, color FROM vis2)
""".format(expr=SQL_EXPR_SERVE, color=SQL_COLOR, bg=SQL_BACKGROUND["serve"], ct=SQL_CONTRAST["serve"])


def _vision(spark, sf_dir):
    apply_core_conf(spark)
    return pr.serving_vision(annotations(spark, sf_dir))


@key("score_breakdown", SQL_VISION + "SELECT * FROM dims")
def q_score_breakdown(spark, sf_dir):
    long = pr.dimension_long(pr.score_result(_vision(spark, sf_dir)))
    return long.select("video_id", "dimension", "score", "max", "value")


@key("dimension_long", SQL_VISION + "SELECT *, CAST(round(score / max * 100) AS INT) AS percent, "
     "CASE WHEN score / max >= 0.75 THEN 'high' WHEN score / max >= 0.5 THEN 'mid' "
     "WHEN score / max >= 0.25 THEN 'low' ELSE 'poor' END AS tier FROM dims")
def q_dimension_long(spark, sf_dir):
    return pr.dimension_long(pr.score_result(_vision(spark, sf_dir)))


_SQL_PTS = {
    "text": ("CASE WHEN text_length > 0 THEN (CASE WHEN text_length > 50 THEN 10.0e0 "
             "WHEN text_length > 20 THEN 8.5e0 ELSE 7.0e0 END) ELSE 0.0e0 END"),
    "face": "CASE WHEN nb_faces = 1 THEN 4.0e0 WHEN nb_faces = 2 THEN 2.0e0 ELSE 0.0e0 END",
    "expression": "CASE WHEN expression = 'Neutre' THEN 3.0e0 WHEN expression = 'Sourire' THEN 2.5e0 ELSE 0.0e0 END",
    "colors": "CASE WHEN color = 'Froid' THEN 3.0e0 WHEN color = 'Neutre' THEN 1.5e0 ELSE 0.0e0 END",
}
_SQL_VALUES = {"text": "text_content", "face": "CAST(nb_faces AS VARCHAR)", "expression": "expression",
               "colors": "color"}
_SQL_MAX = {"text": 10, "face": 4, "expression": 3, "colors": 3}
SQL_RULE_SCORE = "round_even(" + " + ".join(_SQL_PTS.values()) + ", 1)"


def result_json_sql(score: str) -> str:
    """The nested result as JSON text, over the columns of ``vis2`` and an expression of the score."""
    dims = ", ".join(f"'{d}': {{'score': {_SQL_PTS[d]}, 'max': {_SQL_MAX[d]}, 'value': {_SQL_VALUES[d]}}}" for d in _SQL_PTS)
    return (f"to_json({{'score': {score}, 'score_max': 20, 'dimensions': {{{dims}}}, "
            "'vision': {'text_present': text_length > 0, 'text_length': CAST(text_length AS INT), "
            "'text_content': text_content, 'nb_faces': nb_faces, 'expression': expression, 'color': color, "
            "'background': background, 'contrast': contrast, 'face_conf': face_conf}})::VARCHAR")


@key("score_result_json", SQL_VISION + f"SELECT video_id, {result_json_sql(SQL_RULE_SCORE)} AS json FROM vis2")
def q_score_result_json(spark, sf_dir):
    return pr.result_json(pr.score_result(_vision(spark, sf_dir)))


@key("attribute_flags", SQL_VISION + """
 SELECT video_id, 'text' AS attribute, CAST(text_length AS VARCHAR) AS value,
        CASE WHEN text_length > 0 THEN 'good' ELSE 'bad' END AS flag FROM vis2
 UNION ALL SELECT video_id, 'faces', CAST(nb_faces AS VARCHAR),
        CASE WHEN nb_faces = 1 THEN 'good' WHEN nb_faces = 2 THEN 'neutral' ELSE 'bad' END FROM vis2
 UNION ALL SELECT video_id, 'expression', expression, CASE WHEN expression IN ('Neutre', 'Sourire') THEN 'good'
        WHEN expression <> 'Aucun' THEN 'neutral' ELSE 'bad' END FROM vis2
 UNION ALL SELECT video_id, 'colors', color, CASE WHEN color = 'Froid' THEN 'good' WHEN color = 'Neutre'
        THEN 'neutral' ELSE 'bad' END FROM vis2
 UNION ALL SELECT video_id, 'background', background, CASE WHEN background <> 'Chargé' THEN 'neutral'
        ELSE 'bad' END FROM vis2
 UNION ALL SELECT video_id, 'contrast', contrast, 'neutral' FROM vis2""")
def q_attribute_flags(spark, sf_dir):
    return pr.attribute_flags(_vision(spark, sf_dir))


@key("score_label", f", {scored_cte('niche')} SELECT video_id, thumbnail_score, CASE WHEN thumbnail_score >= 15 "
     "THEN 'Excellent' WHEN thumbnail_score >= 10 THEN 'Good' WHEN thumbnail_score >= 5 THEN 'Below average' "
     "ELSE 'Poor' END AS score_label FROM scored", E)
def q_score_label(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("video_id", "thumbnail_score", score_label("thumbnail_score").alias("score_label"))


@key("weights_v4", f", {scored_cte('niche')}, l AS ({_flag_union('performance_score', RAW_LIFT_SQL, 'raw')}) "
     "SELECT feature, round(raw, 6) AS lift, round(20 * ln(raw) / sum(ln(raw)) OVER (), 6) AS points FROM l WHERE raw > 1", E)
def q_weights_v4(spark, sf_dir):
    lift = st.feature_lift(scored(spark, sf_dir), analysis_flags(), "performance_score", digits=None)
    return pr.weights_from_lift(lift)
