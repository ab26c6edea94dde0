"""Joins against look-up tables and per-group statistics.

No side is forced to be broadcast.  Derived sides are written once to the shared
folder, so Spark knows their size in bytes: it broadcasts them below the session's
``autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution splits
the partitions of hot keys.  Nothing stays cached in the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from perfscore.session import materialize


def small_side(small: DataFrame) -> DataFrame:
    """A derived (aggregated) side, written once: every use reads it, with its size known."""
    return materialize(small, "side")


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join ``big`` with a dimension (one row per key)."""
    return big.join(small, on=on, how=how)


def stats_join(big: DataFrame, stats: DataFrame, keys: list[str], count_col: str = "_n",
               how: str = "left") -> DataFrame:
    """Join per-group statistics back to the rows; the count column stays behind."""
    return big.join(small_side(stats.drop(count_col)), keys, how)
