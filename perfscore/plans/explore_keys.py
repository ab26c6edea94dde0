"""Driver keys: exploration aggregates (G) over the scored fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions.features import analysis_flags
from perfscore.operators import explore as ex
from perfscore.operators import stats as st
from perfscore.operators.scoring import with_performance
from perfscore.plans.common import SQL_PERF, enriched, scored, scored_cte, videos_raw
from perfscore.plans.fixtures import AS_OF
from perfscore.plans.registry import key
from perfscore.plans.scoring_keys import RAW_DIFF_SQL, _flag_union

E = ("f_enriched",)
V = ("f_videos_raw",)

# Columns of f_enriched with their Spark types (the profile reports these).
ENRICHED_TYPES = (
    ("video_id", "string"), ("title", "string"), ("published_at", "timestamp_ntz"),
    ("channel_id", "string"), ("channel_name", "string"), ("view_count", "bigint"),
    ("duration", "string"), ("subscriber_count", "bigint"), ("thumbnail_path", "string"),
    ("niche", "string"), ("views_per_sub", "double"), ("visage_present", "boolean"),
    ("texte_present", "boolean"), ("nb_personnes", "int"), ("expression", "string"),
    ("texte_contenu", "string"), ("couleur_dominante", "string"), ("contraste", "string"),
    ("fond", "string"), ("face_confidence", "double"),
)
COUNT_COLS = ("nb_personnes", "expression", "couleur_dominante", "fond", "contraste",
              "visage_present", "texte_present")
FEATURE_COLS = ("visage_present", "texte_present", "nb_personnes", "expression", "fond")
TOP_PERFORMER = 0.00177   # fixed value: default top-performer threshold
SEED = 42
NICHE_CODES = {"AUTOMOBILE": 0, "BUILDING": 1}


def _scored_sql(body: str) -> str:
    return f", {scored_cte('niche')} {body}"


@key("profile_columns", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
    f"count({c}) AS non_null FROM f_enriched" for i, (c, t) in enumerate(ENRICHED_TYPES)), E)
def q_profile(spark, sf_dir):
    return ex.profile_columns(enriched(spark, sf_dir))


@key("head_rows", "SELECT * FROM f_enriched ORDER BY video_id LIMIT 5", E)
def q_head_rows(spark, sf_dir):
    return ex.head_rows(enriched(spark, sf_dir), 5)


@key("value_counts_multi", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM f_enriched "
    f"WHERE {c} IS NOT NULL GROUP BY 2" for c in COUNT_COLS), E)
def q_value_counts(spark, sf_dir):
    return ex.value_counts_multi(enriched(spark, sf_dir), COUNT_COLS)


@key("distinct_counts", "SELECT count(*) AS n_rows, count(DISTINCT channel_name) AS n_channel_name, "
     "count(DISTINCT niche) AS n_niche FROM f_enriched", E)
def q_distinct(spark, sf_dir):
    return ex.distinct_counts(enriched(spark, sf_dir), ["channel_name", "niche"])


@key("describe_exact", f", s AS (SELECT {SQL_PERF} AS p FROM f_videos_raw) "
     "SELECT count(p) AS count, round(avg(p), 9) AS mean, round(stddev_samp(p), 9) AS std, "
     "round(min(p), 9) AS min, round(quantile_cont(p, 0.25), 9) AS p25, "
     "round(quantile_cont(p, 0.5), 9) AS p50, round(quantile_cont(p, 0.75), 9) AS p75, "
     "round(max(p), 9) AS max FROM s", V)
def q_describe(spark, sf_dir):
    return ex.describe_exact(with_performance(videos_raw(spark, sf_dir), AS_OF), "performance_score")


@key("histogram_bins", f", s AS (SELECT {SQL_PERF} AS p FROM f_videos_raw), "
     "mm AS (SELECT min(p) AS lo, max(p) AS hi FROM s) "
     "SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((p - lo) / (hi - lo) * 50), 49) END AS INT) AS bin, "
     "count(*) AS n FROM s, mm GROUP BY 1", V)
def q_histogram(spark, sf_dir):
    return ex.histogram_bins(with_performance(videos_raw(spark, sf_dir), AS_OF), "performance_score", 50)


@key("boxplot_stats", f", s AS (SELECT niche, {SQL_PERF} AS p FROM f_videos_raw), "
     "q AS (SELECT niche, quantile_cont(p, 0.25) AS q1, quantile_cont(p, 0.5) AS med, "
     "quantile_cont(p, 0.75) AS q3 FROM s GROUP BY niche) "
     "SELECT s.niche, count(*) AS n, round(q1, 9) AS q1, round(med, 9) AS median, round(q3, 9) AS q3, "
     "round(min(CASE WHEN p >= q1 - 1.5 * (q3 - q1) AND p <= q3 + 1.5 * (q3 - q1) THEN p END), 9) AS whisker_low, "
     "round(max(CASE WHEN p >= q1 - 1.5 * (q3 - q1) AND p <= q3 + 1.5 * (q3 - q1) THEN p END), 9) AS whisker_high, "
     "count(*) FILTER (WHERE NOT (p >= q1 - 1.5 * (q3 - q1) AND p <= q3 + 1.5 * (q3 - q1))) AS n_outliers "
     "FROM s JOIN q ON s.niche = q.niche GROUP BY s.niche, q1, med, q3", V)
def q_boxplot(spark, sf_dir):
    return ex.boxplot_stats(with_performance(videos_raw(spark, sf_dir), AS_OF), "performance_score", "niche")


@key("top_formatted", _scored_sql(
    "SELECT video_id, CASE WHEN length(title) > 50 THEN substr(title, 1, 50) || '...' ELSE title END AS title, "
    "channel_name, niche, format('{:,}', view_count) AS view_count, "
    "format('{:,}', subscriber_count) AS subscriber_count, printf('%.4f', performance_score) AS performance_score "
    "FROM scored ORDER BY scored.performance_score DESC, video_id LIMIT 20"), E)
def q_top_formatted(spark, sf_dir):
    return ex.top_formatted(scored(spark, sf_dir), 20, 50)


@key("category_encode", "SELECT video_id, CASE niche " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in NICHE_CODES.items()) + " END AS niche_code FROM f_enriched", E)
def q_category_encode(spark, sf_dir):
    return enriched(spark, sf_dir).select("video_id", ex.category_encode("niche", NICHE_CODES).alias("niche_code"))


@key("top_bottom_k", _scored_sql(
    "(SELECT video_id, performance_score, 'top' AS side FROM scored ORDER BY performance_score DESC, video_id LIMIT 12) "
    "UNION ALL (SELECT video_id, performance_score, 'bottom' AS side FROM scored "
    "ORDER BY performance_score ASC, video_id LIMIT 12)"), E)
def q_top_bottom(spark, sf_dir):
    df = scored(spark, sf_dir).select("video_id", "performance_score")
    return ex.top_bottom_k(df, "performance_score", 12)


@key("seeded_sample", _scored_sql(
    f"SELECT video_id, thumbnail_score, performance_score FROM scored "
    f"ORDER BY md5(video_id || '{SEED}'), video_id LIMIT 12"), E)
def q_seeded_sample(spark, sf_dir):
    df = scored(spark, sf_dir).select("video_id", "thumbnail_score", "performance_score")
    return ex.seeded_sample(df, 12, SEED)


@key("seeded_sample_band", _scored_sql(
    f"SELECT video_id, thumbnail_score FROM scored WHERE thumbnail_score >= 10 AND thumbnail_score < 15 "
    f"ORDER BY md5(video_id || '{SEED}'), video_id LIMIT 12"), E)
def q_seeded_sample_band(spark, sf_dir):
    df = scored(spark, sf_dir).where((F.col("thumbnail_score") >= 10) & (F.col("thumbnail_score") < 15))
    return ex.seeded_sample(df.select("video_id", "thumbnail_score"), 12, SEED)


@key("null_counts", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM f_enriched_left"
    for c, _ in ENRICHED_TYPES) + " UNION ALL SELECT '__total__', " + " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL)" for c, _ in ENRICHED_TYPES)
    + " FROM f_enriched_left) WHERE n_null > 0 OR column_name = '__total__'", ("f_enriched_left",))
def q_null_counts(spark, sf_dir):
    return ex.null_counts(enriched(spark, sf_dir, left=True))


@key("duplicate_counts", " UNION ALL ".join(
    f"SELECT '{k}' AS key, count(*) - count(DISTINCT {k}) - coalesce(max(CASE WHEN {k} IS NULL THEN 1 ELSE 0 END), 0) "
    f"AS n_duplicates FROM f_enriched" for k in ("video_id", "title")), E)
def q_duplicates(spark, sf_dir):
    return ex.duplicate_counts(enriched(spark, sf_dir), ["video_id", "title"])


@key("value_ranges", _scored_sql(
    "SELECT min(published_at) AS min_published_at, max(published_at) AS max_published_at, "
    "min(view_count) AS min_view_count, max(view_count) AS max_view_count, "
    "min(performance_score) AS min_performance_score, max(performance_score) AS max_performance_score FROM scored"), E)
def q_value_ranges(spark, sf_dir):
    return ex.value_ranges(scored(spark, sf_dir), ["published_at", "view_count", "performance_score"])


@key("label_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c}) AS n_true, "
    f"round(count(*) FILTER (WHERE {c}) * 100.0e0 / count(*), 6) AS pct_true FROM f_enriched"
    for c in ("visage_present", "texte_present")), E)
def q_label_stats(spark, sf_dir):
    return ex.flag_stats(enriched(spark, sf_dir), ["visage_present", "texte_present"])


@key("mean_by_feature", _scored_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, count(*) AS n, "
    f"round(avg(performance_score), 9) AS mean_value FROM scored WHERE {c} IS NOT NULL GROUP BY 2"
    for c in FEATURE_COLS)), E)
def q_mean_by_feature(spark, sf_dir):
    return ex.mean_by_feature(scored(spark, sf_dir), FEATURE_COLS, "performance_score")


@key("importance_rank", f", {scored_cte('niche')}, d AS ({_flag_union('perf_norm', RAW_DIFF_SQL, 'raw')}), "
     "m AS (SELECT median(raw) AS med FROM d) "
     "SELECT feature, round(raw, 6) AS diff, rank() OVER (ORDER BY raw DESC, feature) AS rank, raw >= med AS above_median "
     "FROM d, m", E)
def q_importance(spark, sf_dir):
    diff = st.feature_diff(scored(spark, sf_dir), analysis_flags(), "perf_norm", digits=None).select("feature", "diff")
    return ex.importance_rank(diff, "diff").withColumn("rank", F.col("rank").cast("bigint"))


_RC_BANDS = ("CASE WHEN thumbnail_score > 0 AND thumbnail_score <= 5 THEN '0-5' "
             "WHEN thumbnail_score > 5 AND thumbnail_score <= 10 THEN '5-10' "
             "WHEN thumbnail_score > 10 AND thumbnail_score <= 15 THEN '10-15' "
             "WHEN thumbnail_score > 15 AND thumbnail_score <= 20 THEN '15-20' END")


@key("bands_right_closed", _scored_sql(
    f", b AS (SELECT {_RC_BANDS} AS band, performance_score FROM scored), "
    "a AS (SELECT band, count(*) AS n, round(avg(performance_score), 9) AS mean_value FROM b "
    "WHERE band IS NOT NULL GROUP BY band), "
    "l AS (SELECT * FROM (VALUES (0, '0-5'), (1, '5-10'), (2, '10-15'), (3, '15-20')) t(band_order, band)) "
    "SELECT l.band_order, l.band, coalesce(a.n, 0) AS n, a.mean_value FROM l LEFT JOIN a ON l.band = a.band"), E)
def q_bands_rc(spark, sf_dir):
    return ex.bands_right_closed(scored(spark, sf_dir), "thumbnail_score", "performance_score")


@key("band_top_share", _scored_sql(
    f", b AS (SELECT {_RC_BANDS} AS band, performance_score FROM scored) "
    "SELECT band, count(*) AS n, round(avg(performance_score), 9) AS mean_value, "
    f"round(avg(CASE WHEN performance_score >= {TOP_PERFORMER} THEN 1 ELSE 0 END) * 100, 6) AS pct_top "
    "FROM b WHERE band IS NOT NULL GROUP BY band"), E)
def q_band_top_share(spark, sf_dir):
    return ex.band_top_share(scored(spark, sf_dir), "thumbnail_score", "performance_score", TOP_PERFORMER)


@key("channel_scores", _scored_sql(
    "SELECT channel_name, round(avg(thumbnail_score), 2) AS mean_score, "
    "round(avg(performance_score), 2) AS mean_performance, count(video_id) AS video_count "
    "FROM scored WHERE channel_name IS NOT NULL GROUP BY channel_name"), E)
def q_channel_scores(spark, sf_dir):
    return ex.channel_scores(scored(spark, sf_dir), "channel_name", "thumbnail_score", "performance_score")
