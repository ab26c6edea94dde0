"""Score presentation: nested score result, long dimension form, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.functions import labels as lb
from perfscore.operators.joins import small_side
from perfscore.functions.scoring import (DIMENSION_MAX, V5, Weights, color_points,
                                         expression_points, person_points, text_points, tier)

DIMENSIONS = ("text", "face", "expression", "colors")
SERVE_TEXT_CHARS = 200


def serving_vision(annotations: DataFrame, max_chars: int = SERVE_TEXT_CHARS) -> DataFrame:
    """Vision summary of the serving path (raw face count, serve profile)."""
    text = lb.text_content(max_chars=max_chars)
    return annotations.select(
        "video_id",
        text.alias("text_content"),
        F.length(text).alias("text_length"),
        lb.face_count().alias("nb_faces"),
        lb.expression_label(profile="serve").alias("expression"),
        lb.color_label().alias("color"),
        lb.background_label(profile="serve").alias("background"),
        lb.contrast_label(profile="serve").alias("contrast"),
        F.bround(lb.face_confidence(), 3).alias("face_conf"))


def score_result(vision: DataFrame, score_col=None, w: Weights = V5) -> DataFrame:
    """Nested result per row: total, max, per-dimension (score, max, value), vision.

    Text counts as present when its length is above 0 (serving rule).
    ``value`` is a STRING so the four dimensions share one type.
    """
    tl = F.col("text_length")
    pts = {
        "text": text_points(tl > 0, tl, w),
        "face": person_points("nb_faces", w),
        "expression": expression_points("expression", w),
        "colors": color_points("color", w),
    }
    values = {"text": F.col("text_content"), "face": F.col("nb_faces").cast("string"),
              "expression": F.col("expression"), "colors": F.col("color")}
    dims = F.struct(*[F.struct(pts[d].alias("score"), F.lit(DIMENSION_MAX[d]).alias("max"),
                               values[d].alias("value")).alias(d) for d in DIMENSIONS])
    total = pts["text"] + pts["face"] + pts["expression"] + pts["colors"]
    score = F.bround(score_col if score_col is not None else total, 1)
    vis = F.struct((tl > 0).alias("text_present"), tl.alias("text_length"),
                   "text_content", "nb_faces", "expression", "color", "background", "contrast",
                   "face_conf")
    return vision.select("video_id", F.struct(score.alias("score"), F.lit(20).alias("score_max"),
                                              dims.alias("dimensions"), vis.alias("vision")).alias("result"))


def result_json(results: DataFrame) -> DataFrame:
    """The wire form of the nested result."""
    return results.select("video_id", F.to_json("result").alias("json"))


def dimension_long(results: DataFrame) -> DataFrame:
    """One row per (video, dimension): score, max, value, percent and tier."""
    long = results.select("video_id", F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(f"result.dimensions.{d}.score").alias("score"),
                 F.col(f"result.dimensions.{d}.max").alias("max"),
                 F.col(f"result.dimensions.{d}.value").alias("value"))
        for d in DIMENSIONS])).alias("d")).select("video_id", "d.*")
    frac = F.col("score") / F.col("max")
    return long.withColumn("percent", F.round(frac * 100).cast("int")).withColumn("tier", tier(frac))


def attribute_flags(vision: DataFrame) -> DataFrame:
    """good / neutral / bad per attribute, long form."""
    good, neutral, bad = F.lit("good"), F.lit("neutral"), F.lit("bad")
    tl, nb, ex, co = F.col("text_length"), F.col("nb_faces"), F.col("expression"), F.col("color")
    expr_good = ex.isin("Neutre", "Sourire")
    flags = {
        "text": (F.when(tl > 0, good).otherwise(bad), tl.cast("string")),
        "faces": (F.when(nb == 1, good).when(nb == 2, neutral).otherwise(bad), nb.cast("string")),
        "expression": (F.when(expr_good, good).when(ex != "Aucun", neutral).otherwise(bad), ex),
        "colors": (F.when(co == "Froid", good).when(co == "Neutre", neutral).otherwise(bad), co),
        "background": (F.when(F.col("background") != "Chargé", neutral).otherwise(bad), F.col("background")),
        "contrast": (neutral, F.col("contrast")),
    }
    return vision.select("video_id", F.explode(F.array(*[
        F.struct(F.lit(k).alias("attribute"), v.alias("value"), f.alias("flag"))
        for k, (f, v) in flags.items()])).alias("a")).select("video_id", "a.*")


def weights_from_lift(lift: DataFrame, total: float = 20.0, digits: int = 6) -> DataFrame:
    """v4 points: proportional to ln(multiplier) over multipliers above 1.

    The lift table (one row per feature) is materialised once; the normalising
    sum then enters as a scalar subquery over it, so the data is read once.
    """
    pos = small_side(lift.where(F.col("lift") > 1).withColumn("_ln", F.ln("lift")))
    total_ln = pos.select(F.sum("_ln")).scalar()
    return pos.select("feature", F.round("lift", digits).alias("lift"),
                      F.round(F.lit(total) * F.col("_ln") / total_ln, digits).alias("points"))
