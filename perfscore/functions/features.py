"""Model features as native expressions (H1-H3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tabular feature order of the stored model metadata.
TAB_FEATURES = (
    "has_text", "text_short", "text_medium", "text_long",
    "one_person", "two_people", "many_people",
    "bg_busy", "bg_blur",
    "color_neutral", "color_cold", "color_warm",
    "contrast_high", "contrast_med",
    "expr_neutral", "expr_smile",
    "face_conf", "niche_ai", "log_subs", "channel_avg_perf",
)
AI_NICHE = "AI/Tech"

# Request defaults of the scoring service.
DEFAULT_SUBSCRIBERS = 100_000
DEFAULT_CHANNEL_AVG_PERF = 0.003
DEFAULT_NICHE = AI_NICHE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def image_flags(text_present="texte_present", text_len="text_length",
                persons="nb_personnes", background="fond", color="couleur_dominante",
                contrast="contraste", expression="expression") -> dict[str, Column]:
    """The 0/1 image conditions (booleans) keyed by feature name."""
    tl, nb = _c(text_len), _c(persons)
    return {
        "has_text": F.coalesce(_c(text_present), F.lit(False)),
        "text_short": (tl > 0) & (tl <= 20),
        "text_medium": (tl > 20) & (tl <= 50),
        "text_long": tl > 50,
        "one_person": nb == 1,
        "two_people": nb == 2,
        "many_people": nb >= 3,
        "bg_busy": _c(background) == "Chargé",
        "bg_blur": _c(background) == "Flou",
        "color_neutral": _c(color) == "Neutre",
        "color_cold": _c(color) == "Froid",
        "color_warm": _c(color) == "Chaud",
        "contrast_high": _c(contrast) == "Élevé",
        "contrast_med": _c(contrast) == "Moyen",
        "expr_neutral": _c(expression) == "Neutre",
        "expr_smile": _c(expression) == "Sourire",
    }


def analysis_flags() -> dict[str, Column]:
    """Flags used by the lift / difference / confound reports."""
    flags = image_flags()
    flags["face"] = F.coalesce(F.col("visage_present"), F.lit(False))
    flags["contrast_low"] = F.col("contraste") == "Faible"
    return flags


def as_double(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("double")


def image_feature_columns(face_conf="face_confidence", **kw) -> list[Column]:
    cols = [as_double(c).alias(n) for n, c in image_flags(**kw).items()]
    cols.append(F.coalesce(_c(face_conf), F.lit(0.0)).cast("double").alias("face_conf"))
    return cols


def channel_feature_columns(niche="niche", subscribers="subscriber_count",
                            channel_avg="channel_avg_perf") -> list[Column]:
    return [
        as_double(_c(niche) == AI_NICHE).alias("niche_ai"),
        F.log1p(_c(subscribers).cast("double")).alias("log_subs"),
        _c(channel_avg).cast("double").alias("channel_avg_perf"),
    ]
