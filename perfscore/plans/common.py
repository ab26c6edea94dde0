"""Shared inputs of the driver keys and the SQL twins of common expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perfscore.operators.scoring import score_table, with_performance, with_rule_score
from perfscore.plans.fixtures import AS_OF, enriched_measured, fixture
from perfscore.session import apply_core_conf

# SQL twins (DuckDB) of the library's column expressions.
SQL_PERF = (f"view_count / greatest(date_sub('day', published_at, TIMESTAMP '{AS_OF}'), 1)"
            " / greatest(subscriber_count, 1)")
SQL_TEXT_LEN = "length(coalesce(texte_contenu, ''))"
SQL_SCORE = f"""(CASE WHEN coalesce(texte_present, false) THEN
       (CASE WHEN {SQL_TEXT_LEN} > 50 THEN 10.0e0 WHEN {SQL_TEXT_LEN} > 20 THEN 8.5e0 ELSE 7.0e0 END)
     ELSE 0.0e0 END
 + CASE WHEN nb_personnes = 1 THEN 4.0e0 WHEN nb_personnes = 2 THEN 2.0e0 ELSE 0.0e0 END
 + CASE WHEN expression = 'Neutre' THEN 3.0e0 WHEN expression = 'Sourire' THEN 2.5e0 ELSE 0.0e0 END
 + CASE WHEN couleur_dominante = 'Froid' THEN 3.0e0 WHEN couleur_dominante = 'Neutre' THEN 1.5e0 ELSE 0.0e0 END)"""


def scored_cte(group: str = "niche") -> str:
    """CTE ``scored``: f_enriched + performance, score and within-group z."""
    return f"""scored0 AS (
  SELECT *, {SQL_PERF} AS performance_score, {SQL_TEXT_LEN} AS text_length,
         {SQL_SCORE} AS thumbnail_score
  FROM f_enriched),
scored AS (
  SELECT *, (performance_score - avg(performance_score) OVER (PARTITION BY {group}))
            / (stddev_samp(performance_score) OVER (PARTITION BY {group}) + 1e-9) AS perf_norm
  FROM scored0)"""


def sql_corr(x: str, y: str, digits: int = 6) -> str:
    c = f"corr({x}, {y})"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE round({c}, {digits}) END"


def videos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_core_conf(spark)
    return fixture(spark, sf_dir, "f_videos_raw")


def enriched(spark: SparkSession, sf_dir: str, left: bool = False) -> DataFrame:
    apply_core_conf(spark)
    return fixture(spark, sf_dir, "f_enriched_left" if left else "f_enriched")


def enriched_perf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_performance(enriched(spark, sf_dir), AS_OF)


def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched + performance + rule score, without the within-group z; the texts' lengths alone go along."""
    apply_core_conf(spark)
    return with_rule_score(with_performance(enriched_measured(spark, sf_dir), AS_OF))


def scored(spark: SparkSession, sf_dir: str, group: str = "niche") -> DataFrame:
    """Enriched + performance, rule score and within-group z; the texts' lengths alone go along."""
    apply_core_conf(spark)
    return score_table(enriched_measured(spark, sf_dir), AS_OF, group_cols=group)
