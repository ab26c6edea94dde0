"""Rule score v5 and its presentation, as native column expressions."""

from __future__ import annotations

from dataclasses import dataclass, asdict

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Weights:
    """Points of the v5 rule score (fixed values of the published weights)."""
    text_short: float = 7.0
    text_medium: float = 8.5
    text_long: float = 10.0
    one_person: float = 4.0
    two_people: float = 2.0
    expr_neutral: float = 3.0
    expr_smile: float = 2.5
    color_cold: float = 3.0
    color_neutral: float = 1.5
    max_score: float = 20.0

    def as_dict(self) -> dict:
        return asdict(self)


V5 = Weights()

# Text length thresholds (characters) and the per-dimension maxima.
TEXT_MEDIUM_OVER = 20
TEXT_LONG_OVER = 50
DIMENSION_MAX = {"text": 10, "face": 4, "expression": 3, "colors": 3}

# Score labels and bar tiers of the presentation layer.
SCORE_LABELS = ((15, "Excellent"), (10, "Good"), (5, "Below average"))
SCORE_LABEL_ELSE = "Poor"
TIERS = ((0.75, "high"), (0.5, "mid"), (0.25, "low"))
TIER_ELSE = "poor"

# The two band conventions over 0..20.
BAND_EDGES = (0, 5, 10, 15, 20)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_length(text="texte_contenu") -> Column:
    """Characters of the OCR text; missing → 0."""
    return F.length(F.coalesce(_c(text), F.lit(""))).cast("bigint")


def text_points(present, length, w: Weights = V5) -> Column:
    """Present text earns points by length; NULL presence counts as absent."""
    ln = _c(length)
    pts = (F.when(ln > TEXT_LONG_OVER, F.lit(w.text_long))
           .when(ln > TEXT_MEDIUM_OVER, F.lit(w.text_medium))
           .otherwise(F.lit(w.text_short)))
    return F.when(F.coalesce(_c(present), F.lit(False)), pts).otherwise(F.lit(0.0))


def person_points(n_persons, w: Weights = V5) -> Column:
    n = _c(n_persons)
    return (F.when(n == 1, F.lit(w.one_person)).when(n == 2, F.lit(w.two_people))
            .otherwise(F.lit(0.0)))


def expression_points(expression, w: Weights = V5) -> Column:
    e = _c(expression)
    return (F.when(e == "Neutre", F.lit(w.expr_neutral)).when(e == "Sourire", F.lit(w.expr_smile))
            .otherwise(F.lit(0.0)))


def color_points(color, w: Weights = V5) -> Column:
    c = _c(color)
    return (F.when(c == "Froid", F.lit(w.color_cold)).when(c == "Neutre", F.lit(w.color_neutral))
            .otherwise(F.lit(0.0)))


def score_v5(present="texte_present", length="text_length", n_persons="nb_personnes",
             expression="expression", color="couleur_dominante", w: Weights = V5) -> Column:
    """Sum of the four dimension points, 0..20, rounded half-even to 0.1."""
    total = (text_points(present, length, w) + person_points(n_persons, w)
             + expression_points(expression, w) + color_points(color, w))
    return F.bround(total, 1)


def score_label(score) -> Column:
    s = _c(score)
    out = None
    for lo, name in SCORE_LABELS:
        out = F.when(s >= lo, F.lit(name)) if out is None else out.when(s >= lo, F.lit(name))
    return out.otherwise(F.lit(SCORE_LABEL_ELSE))


def tier(fraction) -> Column:
    f = _c(fraction)
    out = None
    for lo, name in TIERS:
        out = F.when(f >= lo, F.lit(name)) if out is None else out.when(f >= lo, F.lit(name))
    return out.otherwise(F.lit(TIER_ELSE))


def _band_name(lo: int, hi: int) -> str:
    return f"{lo}-{hi}"


def band_half_open(score, edges=BAND_EDGES) -> Column:
    """``[lo, hi)`` bands; the top edge itself falls in no band (NULL)."""
    s = _c(score)
    out = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = (s >= lo) & (s < hi)
        out = (F.when(cond, F.lit(_band_name(lo, hi))) if out is None
               else out.when(cond, F.lit(_band_name(lo, hi))))
    return out


def band_right_closed(score, edges=BAND_EDGES) -> Column:
    """``(lo, hi]`` bands as binned by pandas ``cut``; the bottom edge → NULL."""
    s = _c(score)
    out = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = (s > lo) & (s <= hi)
        out = (F.when(cond, F.lit(_band_name(lo, hi))) if out is None
               else out.when(cond, F.lit(_band_name(lo, hi))))
    return out


def band_names(edges=BAND_EDGES) -> list[str]:
    return [_band_name(lo, hi) for lo, hi in zip(edges[:-1], edges[1:])]
