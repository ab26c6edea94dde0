"""Driver keys: labels from nested annotations."""

from __future__ import annotations

from perfscore.functions import labels as lb
from perfscore.plans.fixtures import ANNOTATION_SCALARS_SQL, annotations
from perfscore.plans.registry import key
from perfscore.session import apply_core_conf

_A = f"""WITH a AS ({ANNOTATION_SCALARS_SQL}),
b AS (SELECT *, greatest(joy, 1) AS lj, greatest(sorrow, 1) AS ls, greatest(anger, 1) AS la,
             greatest(surprise, 1) AS lu, greatest(joy, sorrow, anger, surprise) AS raw_max,
             lower(array_to_string(list_transform(range(n_labels),
                   lambda i: CASE WHEN i = 0 THEN label0 ELSE 'obj' || CAST(i AS VARCHAR) END), ' ')) AS joined,
             array_to_string(list_transform(range(least(n_labels, 5)),
                   lambda i: CASE WHEN i = 0 THEN label0 ELSE 'obj' || CAST(i AS VARCHAR) END), ',') AS top5
      FROM a),
c AS (SELECT *, greatest(lj, ls, la, lu) AS lm FROM b)
"""

SQL_EXPR_LABEL = ("CASE WHEN n_faces = 0 THEN 'Aucun' WHEN lm >= 4 THEN "
                  "(CASE WHEN lj = lm THEN 'Sourire' WHEN ls = lm THEN 'Intense' WHEN la = lm THEN 'Intense' "
                  "ELSE 'Surprise' END) ELSE 'Neutre' END")
SQL_EXPR_SERVE = ("CASE WHEN n_faces = 0 THEN 'Aucun' WHEN raw_max >= 4 THEN "
                  "(CASE WHEN joy = raw_max THEN 'Sourire' WHEN surprise = raw_max THEN 'Surprise' "
                  "ELSE 'Intense' END) ELSE 'Neutre' END")
SQL_COLOR = ("CASE WHEN n_colors = 0 THEN 'Neutre' WHEN r > g AND r > b AND r > 150 THEN 'Chaud' "
             "WHEN (b > r AND b > g AND b > 150) OR (g > r AND g > b AND g > 150) THEN 'Froid' "
             "ELSE 'Neutre' END")
SQL_CONTRAST = {
    "label": "CASE WHEN n_colors = 0 THEN 'Moyen' WHEN n_colors > 8 THEN 'Élevé' "
             "WHEN n_colors < 4 THEN 'Faible' ELSE 'Moyen' END",
    "serve": "CASE WHEN n_colors > 8 THEN 'Élevé' WHEN n_colors < 4 THEN 'Faible' ELSE 'Moyen' END",
}


def _words(words) -> str:
    return "(" + " OR ".join(f"contains(joined, '{w}')" for w in words) + ")"


SQL_BACKGROUND = {
    "label": (f"CASE WHEN {_words(lb.PLAIN_WORDS['label'])} THEN 'Uni' WHEN n_labels > 10 THEN 'Chargé' "
              f"WHEN {_words(lb.BLUR_WORDS)} THEN 'Flou' WHEN n_labels > 7 THEN 'Chargé' ELSE 'Uni' END"),
    "serve": (f"CASE WHEN {_words(lb.PLAIN_WORDS['serve'])} THEN 'Uni' WHEN n_labels > 7 THEN 'Chargé' "
              "ELSE 'Uni' END"),
}
SQL_TEXT = "CASE WHEN n_texts > 0 THEN coalesce(substr(text, 1, 100), '') ELSE '' END"


def _ann(spark, sf_dir):
    apply_core_conf(spark)
    return annotations(spark, sf_dir)


@key("expression_label", _A + f"SELECT video_id, {SQL_EXPR_LABEL} AS expression FROM c")
def q_expression(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.expression_label(profile="label").alias("expression"))


@key("expression_label_serve", _A + f"SELECT video_id, {SQL_EXPR_SERVE} AS expression FROM c")
def q_expression_serve(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.expression_label(profile="serve").alias("expression"))


@key("color_label", _A + f"SELECT video_id, {SQL_COLOR} AS couleur_dominante FROM c")
def q_color(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.color_label().alias("couleur_dominante"))


@key("contrast_label", _A + f"SELECT video_id, {SQL_CONTRAST['label']} AS contraste FROM c")
def q_contrast(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.contrast_label(profile="label").alias("contraste"))


@key("contrast_label_serve", _A + f"SELECT video_id, {SQL_CONTRAST['serve']} AS contraste FROM c")
def q_contrast_serve(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.contrast_label(profile="serve").alias("contraste"))


@key("background_label", _A + f"SELECT video_id, {SQL_BACKGROUND['label']} AS fond FROM c")
def q_background(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.background_label(profile="label").alias("fond"))


@key("background_label_serve", _A + f"SELECT video_id, {SQL_BACKGROUND['serve']} AS fond FROM c")
def q_background_serve(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.background_label(profile="serve").alias("fond"))


@key("face_bucket", _A + "SELECT video_id, n_faces > 0 AS visage_present, "
     "CAST(least(n_faces, 3) AS INT) AS nb_personnes FROM c")
def q_face_bucket(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.face_present().alias("visage_present"),
                                      lb.person_bucket().alias("nb_personnes"))


@key("text_label", _A + f"SELECT video_id, n_texts > 1 AS texte_present, {SQL_TEXT} AS texte_contenu FROM c")
def q_text_label(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.text_present().alias("texte_present"),
                                      lb.text_content().alias("texte_contenu"))


@key("top_labels", _A + "SELECT video_id, top5 AS labels FROM c")
def q_top_labels(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.top_labels().alias("labels"))


@key("confidences", _A + "SELECT video_id, CASE WHEN n_faces > 0 THEN face_conf ELSE 0.0e0 END AS face_confidence, "
     "CASE WHEN n_texts > 1 THEN text_conf ELSE 0.0e0 END AS text_confidence FROM c")
def q_confidences(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", lb.face_confidence().alias("face_confidence"),
                                      lb.text_confidence().alias("text_confidence"))


@key("labels_build", _A + "SELECT video_id, n_faces > 0 AS visage_present, "
     f"CAST(least(n_faces, 3) AS INT) AS nb_personnes, {SQL_EXPR_LABEL} AS expression, "
     f"n_texts > 1 AS texte_present, {SQL_TEXT} AS texte_contenu, {SQL_COLOR} AS couleur_dominante, "
     f"{SQL_CONTRAST['label']} AS contraste, {SQL_BACKGROUND['label']} AS fond, top5 AS labels, "
     "CASE WHEN n_faces > 0 THEN face_conf ELSE 0.0e0 END AS face_confidence, "
     "CASE WHEN n_texts > 1 THEN text_conf ELSE 0.0e0 END AS text_confidence FROM c")
def q_labels_build(spark, sf_dir):
    return _ann(spark, sf_dir).select("video_id", *lb.label_columns("label"))


LABEL_COUNT_COLS = ("nb_personnes", "expression", "couleur_dominante", "contraste", "fond",
                    "visage_present", "texte_present")
_BUILT_SQL = (f"built AS (SELECT video_id, n_faces > 0 AS visage_present, "
              f"CAST(least(n_faces, 3) AS INT) AS nb_personnes, {SQL_EXPR_LABEL} AS expression, "
              f"n_texts > 1 AS texte_present, {SQL_COLOR} AS couleur_dominante, "
              f"{SQL_CONTRAST['label']} AS contraste, {SQL_BACKGROUND['label']} AS fond FROM c)")


@key("label_value_counts", _A + ", " + _BUILT_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM built "
    f"WHERE {c} IS NOT NULL GROUP BY 2" for c in LABEL_COUNT_COLS))
def q_label_value_counts(spark, sf_dir):
    """C11: frequency of every label value of the labels built from annotations."""
    from perfscore.operators.explore import value_counts_multi
    built = _ann(spark, sf_dir).select("video_id", *lb.label_columns("label"))
    return value_counts_multi(built, LABEL_COUNT_COLS)
