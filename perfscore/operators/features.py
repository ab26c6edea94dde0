"""Feature tables, standardisation, folds and 0-20 rescaling.

Fitted constants (column means and deviations, score bounds) are a handful of
numbers: they come from one global aggregate and enter the plan as literals
or scalar subqueries, never by joining the data with itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfscore.functions import labels as lb
from perfscore.functions.features import (AI_NICHE, DEFAULT_CHANNEL_AVG_PERF, DEFAULT_NICHE,
                                          DEFAULT_SUBSCRIBERS, TAB_FEATURES, as_double,
                                          channel_feature_columns, image_feature_columns)
from perfscore.functions.stats import finite, zscore
from perfscore.operators.joins import small_side, stats_join
from perfscore.operators.stats import group_mean, group_stats
from perfscore.session import materialize

SCORE_MAX = 20.0
SIGMAS = 3.0
# Bounds of the stored model (mean ± 3σ of its raw outputs).
MODEL_SCORE_MIN = -2.674614247865975
MODEL_SCORE_MAX = 2.6463283924385905


def feature_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``video_id`` + the 20 features, given a ``channel_avg_perf`` column."""
    feats = image_feature_columns() + channel_feature_columns()
    named = {name: col for name, col in zip(TAB_FEATURES, feats)}
    return df.select("video_id", *keep, *[named[n] for n in TAB_FEATURES])


def training_features(scored: DataFrame, group: str = "channel_name",
                      value: str = "performance_score") -> DataFrame:
    """``video_id`` + the 20 tabular features in model order (labelling profile)."""
    return feature_columns(group_mean(scored, value, group, out="channel_avg_perf"))


def training_input(rows: DataFrame, embeddings: DataFrame | None = None, group: str = "channel_name",
                   value: str = "performance_score", keep: tuple[str, ...] = (), written: str | None = None) -> DataFrame:
    """``video_id, y``, the 20 features (and ``emb``) of the rows that a model is trained on, as a table if ``written`` names one.

    Rows without an embedding go first; the target (within-group z) and the group mean
    feature are then taken over the rows that are left, in one join with the groups'
    statistics.  Rows without a finite target go last.
    """
    if embeddings is None:
        narrow = training_rows(rows, None, group, value, keep)
        return narrow if written is None else materialize(narrow, written)
    keyed = keyed_vectors(embeddings)
    return attach_vectors(training_rows(rows, keyed, group, value, keep), keyed, written)


@dataclass(frozen=True)
class KeyedVectors:
    """Vectors (``video_id, emb``) and, beside them, what names each: its id and, where ids repeat, its number ``_copy``.

    Rows meet the names first, so that groups, targets and folds are made of narrow rows; the vectors come last.
    """

    names: DataFrame
    vectors: DataFrame
    on: list[str]


def keyed_vectors(embeddings: DataFrame) -> KeyedVectors:
    found = embeddings.where(F.col("embedding").isNotNull() & F.col("video_id").isNotNull()).select("video_id", "embedding")
    counts = materialize(found.groupBy("video_id").agg(F.count(F.lit(1)).alias("_n")), "vector_names")
    if not counts.where(F.col("_n") > 1).take(1):
        return KeyedVectors(counts.select("video_id"), found, ["video_id"])
    names = counts.select("video_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_copy"))
    copy = F.row_number().over(Window.partitionBy("video_id").orderBy("video_id")).cast("bigint")
    return KeyedVectors(names, found.withColumn("_copy", copy), ["video_id", "_copy"])


def attach_vectors(rows: DataFrame, keyed: KeyedVectors, written: str | None = None) -> DataFrame:
    """Rows of ``training_rows`` with their vector as ``emb``.

    If ``written`` names a table, the rows are written once, with vectors as they came (single floats take
    half the bytes of ``emb``), which become doubles as they are read.
    """
    joined = rows.join(keyed.vectors, keyed.on).drop("_copy")
    if written is not None:
        joined = materialize(joined, written)
    return joined.withColumn("emb", array_to_vector("embedding")).drop("embedding")


def training_rows(rows: DataFrame, keyed: KeyedVectors | None = None, group: str = "channel_name",
                  value: str = "performance_score", keep: tuple[str, ...] = ()) -> DataFrame:
    """``training_input`` before its vectors are attached (``attach_vectors``): one row per row and vector."""
    if keyed is not None:
        rows = rows.join(keyed.names, "video_id")
        keep = (*keep, *keyed.on[1:])
    joined = stats_join(rows, group_stats(rows, value, group), [group])
    joined = joined.withColumns({"y": zscore(value, "_mean", "_std"), "channel_avg_perf": F.col("_mean")})
    return feature_columns(joined, keep=("y", *keep)).where(finite("y"))


def scaler_stage(scaler: dict[str, tuple[float, float]]) -> SQLTransformer:
    """The fitted scaler as a pipeline stage (saved with the model): ``scaled_<name>`` per column."""
    terms = ", ".join(f"(`{c}` - {m!r}D) / {s!r}D AS `scaled_{c}`" for c, (m, s) in scaler.items())
    return SQLTransformer(statement=f"SELECT *, {terms} FROM __THIS__")


def serving_features(annotations: DataFrame, subscribers: Column | None = None,
                     channel_avg: Column | None = None, niche: Column | None = None,
                     max_chars: int = 200, form: str = "api") -> DataFrame:
    """The 20 features of the serving path from raw annotations.

    ``form='api'``: text counts when its (200-character) content is non-empty;
    ``form='cli'``: text counts when there is more than one text annotation.
    Faces are the raw count; background, contrast and expression use the
    serving profile; ``bg_blur`` is always 0.  Channel values default to the
    service defaults.
    """
    if form not in ("api", "cli"):
        raise ValueError("form must be 'api' or 'cli'")
    tl = F.length(lb.text_content(max_chars=max_chars))
    has_text = (tl > 0) if form == "api" else lb.text_present()
    nb = lb.face_count()
    fond = lb.background_label(profile="serve")
    color = lb.color_label()
    contrast = lb.contrast_label(profile="serve")
    expr = lb.expression_label(profile="serve")
    subs = subscribers if subscribers is not None else F.lit(DEFAULT_SUBSCRIBERS)
    avg = channel_avg if channel_avg is not None else F.lit(DEFAULT_CHANNEL_AVG_PERF)
    nich = niche if niche is not None else F.lit(DEFAULT_NICHE)
    cols = {
        "has_text": as_double(has_text),
        "text_short": as_double((tl > 0) & (tl <= 20)),
        "text_medium": as_double((tl > 20) & (tl <= 50)),
        "text_long": as_double(tl > 50),
        "one_person": as_double(nb == 1),
        "two_people": as_double(nb == 2),
        "many_people": as_double(nb >= 3),
        "bg_busy": as_double(fond == "Chargé"),
        "bg_blur": F.lit(0.0),
        "color_neutral": as_double(color == "Neutre"),
        "color_cold": as_double(color == "Froid"),
        "color_warm": as_double(color == "Chaud"),
        "contrast_high": as_double(contrast == "Élevé"),
        "contrast_med": as_double(contrast == "Moyen"),
        "expr_neutral": as_double(expr == "Neutre"),
        "expr_smile": as_double(expr == "Sourire"),
        "face_conf": lb.face_confidence().cast("double"),
        "niche_ai": as_double(nich == AI_NICHE),
        "log_subs": F.log1p(subs.cast("double")),
        "channel_avg_perf": avg.cast("double"),
    }
    return annotations.select("video_id", *[cols[n].alias(n) for n in TAB_FEATURES])


def fit_moments(df: DataFrame, cols: Sequence[str] = TAB_FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and population std per column, 0 where unknown (one aggregate, one row to the driver)."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m_{i}"] or 0.0, row[f"s_{i}"] or 0.0) for i, c in enumerate(cols)}


def fit_scaler(df: DataFrame, cols: Sequence[str] = TAB_FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and population std per column as the scaler uses them.

    A zero deviation becomes 1 so constant columns map to 0, as the
    reference scaler does; Spark ML's scaler would use the sample std.
    """
    return {c: (m, s or 1.0) for c, (m, s) in fit_moments(df, cols).items()}


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Standardise the fitted columns with literal constants; others pass through."""
    out = []
    for c in df.columns:
        if c in scaler:
            m, s = scaler[c]
            out.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fold_hash(id_col: str = "video_id", seed: int = 42) -> Column:
    """60 bits of md5(id || seed): the place of an id in the seeded permutation."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))
    return F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def assign_folds(df: DataFrame, id_col: str = "video_id", seed: int = 42, k: int = 5, out: str = "fold",
                 rows_per_part: int = 50_000) -> DataFrame:
    """Add a fold 0 .. k-1: rows are ranked in a seeded permutation, and ranks dealt in turn.

    Fold sizes differ by at most one, and an id keeps its fold however the rows are
    partitioned.  The ids alone are ranked, and written once: parts are ranges of the hash of about
    ``rows_per_part`` rows, ranked each for itself, and start where the parts before them end.  The rows
    meet their ranks by id, so rows that were joined by id are not shuffled again.
    """
    ids = df.select(F.col(id_col).alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    ids = materialize(ids.withColumn("_h", fold_hash("_id", seed)), "fold_ids")
    total = ids.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                    F.coalesce(F.max((F.col("_n") > 1) | F.col("_id").isNull()), F.lit(False)).alias("repeated")).first()
    bits = max(0, (total["rows"] // rows_per_part)).bit_length()
    placed = ids.withColumn("_part", F.shiftright("_h", 60 - bits))
    counts = placed.groupBy("_part").agg(F.sum("_n").alias("_c"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    starts = small_side(counts.select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("_part").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, -1)
    ranks = placed.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, "_part").select(
        F.col("_id").alias(id_col), (F.col("_start") + F.col("_before")).alias("_rank"))
    ranked = df.join(ranks, id_col, "left").withColumn("_rank", F.coalesce("_rank", F.lit(0)))  # rows without an id rank first
    if total["repeated"]:  # rows of one id rank one after another
        nth = F.row_number().over(Window.partitionBy(id_col).orderBy(id_col)) - 1
        ranked = ranked.withColumn("_rank", F.col("_rank") + nth)
    return ranked.withColumn(out, F.pmod(F.col("_rank"), F.lit(k).cast("bigint"))).drop("_rank")


def rescale(col, lo, hi, top: float = SCORE_MAX, digits: int = 1) -> Column:
    """Map [lo, hi] to [0, top], clip, round half-even."""
    c = F.col(col) if isinstance(col, str) else col
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    x = F.try_divide(c - lo_c, hi_c - lo_c) * top  # NULL where all values are one
    return F.when(x.isNotNull(), F.bround(F.least(F.greatest(x, F.lit(0.0)), F.lit(top)), digits))


def rescale_stage(col: str, lo: float, hi: float, top: float = SCORE_MAX, out: str = "score_20") -> SQLTransformer:
    """``rescale`` with fixed bounds as a pipeline stage (saved with the model)."""
    x = f"try_divide(`{col}` - {lo!r}D, {hi!r}D - {lo!r}D) * {float(top)!r}D"
    return SQLTransformer(statement=f"SELECT *, CASE WHEN {x} IS NOT NULL THEN "
                                    f"bround(least(greatest({x}, 0.0D), {float(top)!r}D), 1) END AS `{out}` FROM __THIS__")


def rescale_3sigma(df: DataFrame, col: str, out: str = "score_20", sigmas: float = SIGMAS) -> DataFrame:
    """0-20 scale over mean ± 3 population std of ``col`` (bounds as scalar subqueries)."""
    b = df.select(F.struct(F.avg(col).alias("m"), F.stddev_pop(col).alias("s"))).scalar()
    return df.withColumn(out, rescale(col, b["m"] - sigmas * b["s"], b["m"] + sigmas * b["s"]))


def rescale_fixed(df: DataFrame, col: str, lo: float = MODEL_SCORE_MIN, hi: float = MODEL_SCORE_MAX,
                  out: str = "score_20") -> DataFrame:
    return df.withColumn(out, rescale(col, lo, hi))


def top_quantile_label(df: DataFrame, col: str, q: float = 0.75, out: str = "label") -> DataFrame:
    """1 when ``col`` is at or above its exact ``q`` quantile, else 0."""
    from perfscore.operators.quantiles import exact_quantiles
    t = exact_quantiles(df, col, [q], names=["t"]).select("t").scalar()
    return df.withColumn(out, (F.col(col) >= t).cast("int"))
