"""Column expressions for video records (native, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ingest defaults that results depend on.
MIN_VIEWS = 5000                      # videos below this view count are dropped
HIDDEN_TITLES = ("Private video", "Deleted video")
DEFAULT_NICHE = "General"
THUMBNAIL_SIZES = ("maxres", "high", "medium")   # preference order


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_short(duration) -> Column:
    """ISO-8601 duration under one minute.

    Hours present → false; no minutes → seconds < 60; otherwise minutes = 0.
    Anything that does not parse as a number → false (never an error).
    """
    d = _c(duration)
    stripped = F.regexp_replace(F.regexp_replace(d, "PT", ""), "S", "")
    secs = stripped.try_cast("int")
    minutes = F.regexp_replace(F.split_part(d, F.lit("M"), F.lit(1)), "PT", "").try_cast("int")
    return (F.when(d.isNull(), F.lit(False))
            .when(d.contains("H"), F.lit(False))
            .when(~d.contains("M"), F.coalesce(secs < 60, F.lit(False)))
            .otherwise(F.coalesce(minutes == 0, F.lit(False))))


def days_live(published_at, as_of) -> Column:
    """Whole 24 h periods between publication and ``as_of``, at least 1."""
    return F.greatest(
        F.timestamp_diff("DAY", _c(published_at), _c(as_of)), F.lit(1)
    )


def performance_score(views, published_at, subscribers, as_of) -> Column:
    """Views per day divided by subscribers (both divisors at least 1)."""
    days = days_live(published_at, as_of)
    return (_c(views) / days) / F.greatest(_c(subscribers), F.lit(1))


def views_per_sub(views, subscribers) -> Column:
    """The documented variant: views divided by subscribers (at least 1)."""
    return _c(views) / F.greatest(_c(subscribers), F.lit(1)).cast("double")


def best_thumbnail(thumbnails) -> Column:
    """First non-empty url among maxres, high, medium."""
    t = _c(thumbnails)
    return F.coalesce(*[F.nullif(t[size]["url"], F.lit("")) for size in THUMBNAIL_SIZES])


def counter(value) -> Column:
    """API counters arrive as strings; missing or unparsable → 0."""
    return F.coalesce(_c(value).try_cast("bigint"), F.lit(0).cast("bigint"))


def as_of_literal(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")
