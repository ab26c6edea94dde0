"""Fixture views: the domain schema laid over the driver tables.

Each SQL body runs unchanged in Spark SQL and in DuckDB; the Spark side starts
from these views, the oracle side inlines the same text as CTEs, so both engines
read identical inputs.  ``AS_OF`` replaces the wall clock of the ingest.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfscore.functions.scoring import text_length
from perfscore.sources.tables import read_table

AS_OF = "2001-08-02 00:00:00"

F_VIDEOS_RAW = """
SELECT CAST(o.o_orderkey AS VARCHAR(20)) AS video_id,
       CONCAT(o.o_orderpriority, ' ', o.o_orderstatus) AS title,
       o.o_orderdate AS published_at,
       CAST(o.o_custkey AS VARCHAR(20)) AS channel_id, c.c_name AS channel_name,
       CAST(FLOOR(o.o_totalprice) AS BIGINT) AS view_count,
       CASE o.o_orderkey % 8 WHEN 0 THEN 'PT45S' WHEN 1 THEN 'PT1M30S' WHEN 2 THEN 'PT1H2M'
            WHEN 3 THEN 'PT0M30S' WHEN 4 THEN 'P0D' WHEN 5 THEN '' WHEN 6 THEN 'PT75S' ELSE 'PT12M' END AS duration,
       CASE WHEN c.c_acctbal < 0 THEN 0 ELSE CAST(FLOOR(c.c_acctbal) AS BIGINT) END AS subscriber_count,
       CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE CONCAT(CAST(o.o_orderkey AS VARCHAR(20)), '.jpg') END AS thumbnail_path,
       c.c_mktsegment AS niche
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

F_LABELS = """
SELECT CAST(doc_id AS VARCHAR(20)) AS video_id,
       (doc_id % 5) > 0 AS visage_present, (doc_id * 7) % 101 > 0 AS texte_present,
       CAST(CASE WHEN doc_id % 5 > 2 THEN 3 ELSE doc_id % 5 END AS INT) AS nb_personnes,
       CASE WHEN doc_id % 5 = 0 THEN 'Aucun' WHEN doc_id % 4 = 0 THEN 'Neutre' WHEN doc_id % 4 = 1 THEN 'Sourire'
            WHEN doc_id % 4 = 2 THEN 'Surprise' ELSE 'Intense' END AS expression,
       CASE WHEN (doc_id * 7) % 101 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN source
            WHEN doc_id % 4 = 3 THEN CONCAT('source ', source, ', language ', lang) ELSE text END AS texte_contenu,
       CASE doc_id % 3 WHEN 0 THEN 'Froid' WHEN 1 THEN 'Neutre' ELSE 'Chaud' END AS couleur_dominante,
       CASE doc_id % 7 WHEN 0 THEN 'Faible' WHEN 1 THEN 'Élevé' ELSE 'Moyen' END AS contraste,
       CASE doc_id % 6 WHEN 0 THEN 'Flou' WHEN 1 THEN 'Chargé' ELSE 'Uni' END AS fond,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (doc_id % 97) / 100.0e0 END AS face_confidence
FROM documents
"""

_ENRICHED = """
SELECT v.video_id, v.title, v.published_at, v.channel_id, v.channel_name, v.view_count, v.duration,
       v.subscriber_count, v.thumbnail_path, v.niche, v.view_count / (CASE WHEN v.subscriber_count < 1 THEN 1.0e0 ELSE v.subscriber_count END)
       AS views_per_sub, l.visage_present, l.texte_present, l.nb_personnes, l.expression, l.texte_contenu,
       l.couleur_dominante, l.contraste, l.fond, l.face_confidence
FROM (SELECT r.*, CASE WHEN CAST(r.video_id AS BIGINT) % 5 > 0
             THEN CAST(CAST(r.video_id AS BIGINT) % (SELECT count(*) FROM documents) AS VARCHAR(20)) END AS image_id
      FROM f_videos_raw r) v {join} f_labels l ON v.image_id = l.video_id
"""
F_ENRICHED = _ENRICHED.format(join="JOIN")
F_ENRICHED_LEFT = _ENRICHED.format(join="LEFT JOIN")

FIXTURE_SQL = {
    "f_videos_raw": F_VIDEOS_RAW,
    "f_labels": F_LABELS,
    "f_enriched": F_ENRICHED,
    "f_enriched_left": F_ENRICHED_LEFT,
}

# Which fixture views each view depends on (for building oracle CTEs).
_DEPENDS = {
    "f_videos_raw": (),
    "f_labels": (),
    "f_enriched": ("f_videos_raw", "f_labels"),
    "f_enriched_left": ("f_videos_raw", "f_labels"),
}


_SOURCE = re.compile(r"\b(FROM|JOIN) (orders|customer|documents|f_videos_raw|f_labels)\b")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a DataFrame; the caller's session gets no named views."""
    sql = FIXTURE_SQL[name]
    sources = {t: fixture(spark, sf_dir, t) if t in FIXTURE_SQL else read_table(spark, sf_dir, t)
               for _, t in _SOURCE.findall(sql)}
    return spark.sql(_SOURCE.sub(r"\1 {\2}", sql), **sources)


def enriched_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_enriched`` with ``text_length`` in place of the text, which is measured before it is joined.

    Catalyst does not move an expression below a join, and each text would be shuffled once per video that shows it.
    """
    sources = {"f_videos_raw": fixture(spark, sf_dir, "f_videos_raw"), "documents": read_table(spark, sf_dir, "documents"),
               "f_labels": fixture(spark, sf_dir, "f_labels").withColumn("text_length", text_length("texte_contenu"))}
    return spark.sql(_SOURCE.sub(r"\1 {\2}", F_ENRICHED.replace("l.texte_contenu", "l.text_length")), **sources)


def videos_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The raw videos of given order and customer rows (a batch or a stream)."""
    return orders.sparkSession.sql(_SOURCE.sub(r"\1 {\2}", F_VIDEOS_RAW), orders=orders, customer=customer)


def with_fixtures(sql: str, *views: str) -> str:
    """Prefix an oracle query with the fixture views it reads, as CTEs.

    The query may start with ``, name AS (...)`` to append its own CTEs after
    the fixture ones.
    """
    needed: list[str] = []

    def add(view: str) -> None:
        for dep in _DEPENDS[view]:
            add(dep)
        if view not in needed:
            needed.append(view)

    for view in views:
        add(view)
    ctes = ",\n".join(f"{v} AS ({FIXTURE_SQL[v]})" for v in needed)
    return f"WITH {'RECURSIVE ' if 'UNION ALL SELECT f, k + 1' in sql else ''}{ctes}\n{sql}"


# ---------------------------------------------------------------------------
# Nested vision annotations built from ``documents`` (one row per doc_id).
# ---------------------------------------------------------------------------

def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, faces, texts, colors, labels`` as nested arrays of structs."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    doc = F.col("doc_id")
    n_faces = (doc % 5).cast("int")
    n_texts = (doc % 4).cast("int")
    n_colors = (doc % 13).cast("int")
    n_labels = (doc % 13).cast("int")
    conf = (doc % 97) / F.lit(100.0)
    text_conf = (doc % 89) / F.lit(100.0)

    def first_n(n, make):
        return F.transform(F.slice(F.sequence(F.lit(0), F.lit(12)), 1, n), make)

    faces = first_n(n_faces, lambda i: F.when(
        i == 0,
        F.struct((doc % 6).cast("int").alias("joy"),
                 (F.floor(doc / 6) % 6).cast("int").alias("sorrow"),
                 (F.floor(doc / 36) % 6).cast("int").alias("anger"),
                 (F.floor(doc / 216) % 6).cast("int").alias("surprise"),
                 conf.alias("confidence"))).otherwise(
        F.struct(F.lit(0).alias("joy"), F.lit(0).alias("sorrow"),
                 F.lit(0).alias("anger"), F.lit(0).alias("surprise"),
                 conf.alias("confidence"))))
    text_values = F.array(F.col("text"), F.lit("w1"), F.lit("w2"))
    texts = F.transform(F.slice(text_values, 1, n_texts),
                        lambda t: F.struct(t.alias("description"),
                                           text_conf.alias("confidence")))
    colors = first_n(n_colors, lambda i: F.when(
        i == 0,
        F.struct(((doc * 31) % 256).cast("double").alias("red"),
                 ((doc * 57) % 256).cast("double").alias("green"),
                 ((doc * 91) % 256).cast("double").alias("blue"))).otherwise(
        F.struct(F.lit(0.0).alias("red"), F.lit(0.0).alias("green"),
                 F.lit(0.0).alias("blue"))))
    first_label = (F.when(doc % 17 == 0, F.lit("Blue Sky"))
                   .when(doc % 19 == 0, F.lit("Bokeh"))
                   .when(doc % 23 == 0, F.lit("Plain wood")))
    labels = first_n(n_labels, lambda i: F.struct(
        F.when(i == 0, F.coalesce(first_label, F.concat(F.lit("obj"), i.cast("string"))))
        .otherwise(F.concat(F.lit("obj"), i.cast("string"))).alias("description")))
    return d.select(doc.cast("string").alias("video_id"),
                    faces.alias("faces"), texts.alias("texts"),
                    colors.alias("colors"), labels.alias("labels"))


# DuckDB twin of the annotation arithmetic (scalar columns only).
ANNOTATION_SCALARS_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS video_id, doc_id, text,
       CAST(doc_id % 5 AS INT) AS n_faces, CAST(doc_id % 4 AS INT) AS n_texts,
       CAST(doc_id % 13 AS INT) AS n_colors, CAST(doc_id % 13 AS INT) AS n_labels,
       CAST(doc_id % 6 AS INT) AS joy, CAST((doc_id // 6) % 6 AS INT) AS sorrow,
       CAST((doc_id // 36) % 6 AS INT) AS anger, CAST((doc_id // 216) % 6 AS INT) AS surprise,
       (doc_id % 97) / 100.0e0 AS face_conf, (doc_id % 89) / 100.0e0 AS text_conf,
       CAST((doc_id * 31) % 256 AS DOUBLE) AS r, CAST((doc_id * 57) % 256 AS DOUBLE) AS g,
       CAST((doc_id * 91) % 256 AS DOUBLE) AS b,
       CASE WHEN doc_id % 17 = 0 THEN 'Blue Sky' WHEN doc_id % 19 = 0 THEN 'Bokeh'
            WHEN doc_id % 23 = 0 THEN 'Plain wood' ELSE 'obj0' END AS label0
FROM documents
"""
