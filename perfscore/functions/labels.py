"""Categorical labels from raw vision annotations, as native array expressions.

Inputs are the nested columns ``faces``, ``texts``, ``colors``, ``labels``
(arrays of structs).  Two profiles exist because labelling and serving derive
some labels differently: ``'label'`` (default, used for training and scoring)
and ``'serve'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stored category literals.
NO_FACE = "Aucun"
NEUTRAL, SMILE, SURPRISE, INTENSE = "Neutre", "Sourire", "Surprise", "Intense"
WARM, COLD = "Chaud", "Froid"
HIGH, MEDIUM, LOW = "Élevé", "Moyen", "Faible"
PLAIN, BUSY, BLUR = "Uni", "Chargé", "Flou"

# Emotion order decides ties (first wins), per profile.
EMOTION_ORDER = {
    "label": ("joy", "sorrow", "anger", "surprise"),
    "serve": ("joy", "surprise", "anger", "sorrow"),
}
EMOTION_CLASS = {"joy": SMILE, "surprise": SURPRISE, "anger": INTENSE, "sorrow": INTENSE}
LIKELY = 4                       # likelihood at or above which an emotion counts

# Background words searched as substrings of the joined labels.
PLAIN_WORDS = {
    "label": ("sky", "wall", "ceiling", "floor", "plain"),
    "serve": ("sky", "wall", "ceiling", "floor"),
}
BLUR_WORDS = ("blur", "bokeh")
TEXT_MAX_CHARS = 100
TOP_LABELS = 5


def _check(profile: str) -> None:
    if profile not in EMOTION_ORDER:
        raise ValueError(f"profile must be 'label' or 'serve', not {profile!r}")


def likelihood_score(x: Column) -> Column:
    """Vision likelihood enum → 1..5 (unknown and very unlikely both → 1)."""
    return F.greatest(F.coalesce(x, F.lit(1)), F.lit(1))


def expression_label(faces="faces", profile: str = "label") -> Column:
    """Dominant expression of the first face; ``Aucun`` without a face."""
    _check(profile)
    faces = F.col(faces) if isinstance(faces, str) else faces
    first = F.get(faces, 0)
    order = EMOTION_ORDER[profile]
    if profile == "label":
        scores = {e: likelihood_score(first[e]) for e in order}
    else:
        scores = {e: F.coalesce(first[e], F.lit(0)) for e in order}
    top = F.greatest(*scores.values())
    pick = None
    for e in order:
        cond = scores[e] == top
        pick = F.when(cond, F.lit(EMOTION_CLASS[e])) if pick is None else pick.when(cond, F.lit(EMOTION_CLASS[e]))
    return (F.when(F.coalesce(F.size(faces), F.lit(0)) <= 0, F.lit(NO_FACE))
            .when(top >= LIKELY, pick.otherwise(F.lit(NEUTRAL)))
            .otherwise(F.lit(NEUTRAL)))


def color_label(colors="colors") -> Column:
    """Warm / cold / neutral from the first dominant colour."""
    colors = F.col(colors) if isinstance(colors, str) else colors
    c = F.get(colors, 0)
    r, g, b = c["red"], c["green"], c["blue"]
    warm = (r > g) & (r > b) & (r > 150)
    cold = ((b > r) & (b > g) & (b > 150)) | ((g > r) & (g > b) & (g > 150))
    return (F.when(c.isNull(), F.lit(NEUTRAL))
            .when(warm, F.lit(WARM))
            .when(cold, F.lit(COLD))
            .otherwise(F.lit(NEUTRAL)))


def contrast_label(colors="colors", profile: str = "label") -> Column:
    """Contrast from the number of dominant colours."""
    _check(profile)
    colors = F.col(colors) if isinstance(colors, str) else colors
    n = F.coalesce(F.size(colors), F.lit(0))
    n = F.greatest(n, F.lit(0))
    rule = (F.when(n > 8, F.lit(HIGH)).when(n < 4, F.lit(LOW)).otherwise(F.lit(MEDIUM)))
    if profile == "label":
        return F.when(n == 0, F.lit(MEDIUM)).otherwise(rule)
    return rule


def _joined_labels(labels: Column) -> Column:
    return F.lower(F.array_join(F.transform(labels, lambda l: l["description"]), " "))


def _any_word(text: Column, words) -> Column:
    cond = None
    for w in words:
        c = text.contains(w)
        cond = c if cond is None else (cond | c)
    return cond


def background_label(labels="labels", profile: str = "label") -> Column:
    """Plain / busy / blurred background from the label descriptions."""
    _check(profile)
    labels = F.col(labels) if isinstance(labels, str) else labels
    joined = F.coalesce(_joined_labels(labels), F.lit(""))
    n = F.greatest(F.coalesce(F.size(labels), F.lit(0)), F.lit(0))
    if profile == "label":
        return (F.when(_any_word(joined, PLAIN_WORDS["label"]), F.lit(PLAIN))
                .when(n > 10, F.lit(BUSY))
                .when(_any_word(joined, BLUR_WORDS), F.lit(BLUR))
                .when(n > 7, F.lit(BUSY))
                .otherwise(F.lit(PLAIN)))
    return (F.when(_any_word(joined, PLAIN_WORDS["serve"]), F.lit(PLAIN))
            .when(n > 7, F.lit(BUSY))
            .otherwise(F.lit(PLAIN)))


def face_count(faces="faces") -> Column:
    faces = F.col(faces) if isinstance(faces, str) else faces
    return F.greatest(F.coalesce(F.size(faces), F.lit(0)), F.lit(0))


def face_present(faces="faces") -> Column:
    return face_count(faces) > 0


def person_bucket(faces="faces") -> Column:
    """0, 1, 2, or 3 for three or more faces."""
    return F.least(face_count(faces), F.lit(3)).cast("int")


def text_present(texts="texts") -> Column:
    """Real text: more than one annotation (the first is the full text)."""
    texts = F.col(texts) if isinstance(texts, str) else texts
    return F.coalesce(F.size(texts), F.lit(0)) > 1


def text_content(texts="texts", max_chars: int = TEXT_MAX_CHARS) -> Column:
    """First (full) text cut to ``max_chars`` characters; none → ''."""
    texts = F.col(texts) if isinstance(texts, str) else texts
    first = F.get(texts, 0)["description"]
    return F.coalesce(F.substring(first, 1, max_chars), F.lit(""))


def top_labels(labels="labels", n: int = TOP_LABELS) -> Column:
    labels = F.col(labels) if isinstance(labels, str) else labels
    return F.coalesce(
        F.array_join(F.slice(F.transform(labels, lambda l: l["description"]), 1, n), ","),
        F.lit(""))


def face_confidence(faces="faces") -> Column:
    faces = F.col(faces) if isinstance(faces, str) else faces
    return F.coalesce(F.get(faces, 0)["confidence"], F.lit(0.0))


def text_confidence(texts="texts") -> Column:
    """Confidence of the first text, only when real text is present."""
    texts = F.col(texts) if isinstance(texts, str) else texts
    return F.when(text_present(texts), F.coalesce(F.get(texts, 0)["confidence"], F.lit(0.0))
                  ).otherwise(F.lit(0.0))


def label_columns(profile: str = "label", max_chars: int = TEXT_MAX_CHARS) -> list[Column]:
    """The whole label row (without the id), in stored column order."""
    return [
        face_present().alias("visage_present"),
        person_bucket().alias("nb_personnes"),
        expression_label(profile=profile).alias("expression"),
        text_present().alias("texte_present"),
        text_content(max_chars=max_chars).alias("texte_contenu"),
        color_label().alias("couleur_dominante"),
        contrast_label(profile=profile).alias("contraste"),
        background_label(profile=profile).alias("fond"),
        top_labels().alias("labels"),
        face_confidence().alias("face_confidence"),
        text_confidence().alias("text_confidence"),
    ]
