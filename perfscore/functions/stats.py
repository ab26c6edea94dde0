"""Aggregate expressions with the reference's missing-value semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z_EPS = 1e-9   # fixed value: added to the group std before dividing


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def finite(col) -> Column:
    """Non-NULL and not NaN (pandas treats both as missing)."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c)


def pearson(x, y) -> Column:
    """Pearson correlation over pairs where both sides are finite.

    A constant side gives NULL instead of an ANSI divide-by-zero error.
    """
    keep = finite(x) & finite(y)
    xx = F.when(keep, _c(x).cast("double"))
    yy = F.when(keep, _c(y).cast("double"))
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def zscore(value, mean, std, eps: float = Z_EPS) -> Column:
    """``(x - mean) / (std + eps)``; a one-row group has std NULL → NULL."""
    return (_c(value) - _c(mean)) / (_c(std) + F.lit(eps))


def share_true(flag) -> Column:
    """Fraction of rows where the flag is true (NULL flags count as false)."""
    return F.avg(F.coalesce(_c(flag), F.lit(False)).cast("int").cast("double"))
