"""Driver key: the whole chain, landed pages and raw annotations to the band table."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions import labels as lb
from perfscore.functions.scoring import text_length
from perfscore.operators import stats as st
from perfscore.operators.scoring import score_table
from perfscore.plans.common import SQL_SCORE
from perfscore.plans.fixtures import AS_OF, annotations
from perfscore.plans.ingest_keys import BUILT_CTE, built_videos
from perfscore.plans.label_keys import _A, SQL_COLOR, SQL_EXPR_LABEL, SQL_TEXT
from perfscore.plans.registry import key
from perfscore.session import materialize

# BUILT_CTE and the annotation CTEs as one list; the video's image is its number modulo the images.
CHAIN_SQL = f"""{BUILT_CTE.rstrip()}, {_A.removeprefix('WITH ')},
lab AS (SELECT video_id AS image_id, CAST(least(n_faces, 3) AS INT) AS nb_personnes, {SQL_EXPR_LABEL} AS expression,
        n_texts > 1 AS texte_present, {SQL_TEXT} AS texte_contenu, {SQL_COLOR} AS couleur_dominante FROM c),
points AS MATERIALIZED (SELECT CAST(image_id AS BIGINT) AS image, {SQL_SCORE} AS score FROM lab),
added AS MATERIALIZED (SELECT CAST(channel_id AS BIGINT) AS channel, performance_score,
        CAST(video_id AS BIGINT) % (SELECT count(*) FROM documents) AS image FROM built),
rated AS (SELECT channel, performance_score, score FROM added JOIN points USING (image)),
z AS (SELECT score, (performance_score - avg(performance_score) OVER (PARTITION BY channel))
             / (stddev_samp(performance_score) OVER (PARTITION BY channel) + 1e-9) AS z FROM rated)
SELECT CASE WHEN score >= 0 AND score < 5 THEN '0-5' WHEN score >= 5 AND score < 10 THEN '5-10'
            WHEN score >= 10 AND score < 15 THEN '10-15' ELSE '15-20' END AS band,
       count(*) AS n, round(avg(z), 6) AS mean_z FROM z WHERE score < 20 GROUP BY 1"""


SCORED = ("texte_present", "nb_personnes", "expression", "couleur_dominante")


@key("pipeline_bands", CHAIN_SQL, ("f_videos_raw",))
def q_pipeline_bands(spark, sf_dir):
    """Pages → videos; annotations → labels; joined, scored by rule, normalised by channel, banded."""
    videos = built_videos(spark, sf_dir)
    labels = annotations(spark, sf_dir).select(F.col("video_id").alias("image_id"), *lb.label_columns("label"))
    n_images = annotations(spark, sf_dir).count()
    image = (F.col("video_id").cast("bigint") % n_images).cast("string")
    measured = labels.withColumn("text_length", text_length("texte_contenu")).select("image_id", "text_length", *SCORED)
    rows = videos.select("channel_name", "performance_score", image.alias("image_id")).join(measured, "image_id")
    rows = materialize(rows.drop("image_id"), "rated")  # pages and annotations are read once for the statistics and the bands
    return st.score_bands(score_table(rows, AS_OF), "thumbnail_score", "perf_norm")
