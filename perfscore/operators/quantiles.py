"""Exact, linearly interpolated quantiles without holding a hot group in one task.

Rows are first counted per (group, value), a partial aggregate in which ties collapse.
The different values are then range-partitioned by (group, value), which splits a hot
group over many tasks; equal values cannot pile up, as each occurs once.  A value's
ranks are its running count within its part plus the counts of the group's earlier
parts (one row per group and part).  Only values that hold a wanted rank go on.  The
partitioned counts are a table in the shared folder, so the parts stay fixed if an
executor is lost.  One plan serves all sizes.

Interpolation follows the usual (n-1) rule: h = p·(n-1),
q = x[floor h]·(1-d) + x[ceil h]·d with d = h - floor h.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfscore.session import materialize


def _name(p: float) -> str:
    return "q_" + f"{p:g}".replace(".", "_")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """One row per group (or one row) with ``n`` and one column per probability.

    NULL and NaN values and NULL keys take no part; without any value the result is
    empty for groups, and one row of NULLs (n = 0) without groups.
    """
    keys = list(group_cols)
    names = list(names) if names else [_name(p) for p in probs]
    v = F.col(value).cast("double")
    cond = v.isNotNull() & ~F.isnan(v)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    counts = df.where(cond).select(*keys, v.alias("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    parted = counts.repartitionByRange(*keys, "_v").withColumn("_p", F.spark_partition_id())
    parted = materialize(parted, "value_counts")

    # per group and part: what the parts before it hold, and what all parts do
    parts = parted.groupBy(*keys, "_p").agg(F.sum("_c").alias("_s"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"),
                         F.sum("_s").over(whole).alias("n"))
    inside = Window.partitionBy(*keys, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = parted.withColumn("_cum", F.sum("_c").over(inside)).join(parts, [*keys, "_p"])
    end = F.col("_off") + F.col("_cum")
    start = end - F.col("_c")

    def at(rank):
        return F.max(F.when((start <= rank) & (rank < end), F.col("_v")))

    wanted, aggs, outs = F.lit(False), [], []
    for i, (p, nm) in enumerate(zip(probs, names)):
        h = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        wanted = wanted | ((start <= hi) & (lo < end))
        aggs += [at(lo).alias(f"_lo{i}"), at(hi).alias(f"_hi{i}"), F.max(h - lo).alias(f"_d{i}")]
        a, b, d = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_d{i}")
        outs.append(F.when(d == 0, a).otherwise(a * (1 - d) + b * d).alias(nm))
    picked = ranked.where(wanted).groupBy(*keys).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *aggs)
    return picked.select(*keys, "n", *outs)


def exact_median(df: DataFrame, value: str, group_cols: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], group_cols, [name])
