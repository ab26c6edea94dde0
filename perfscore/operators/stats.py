"""Within-group statistics and score validation.

Group statistics use the aggregate-then-join form: a partial/final hash
aggregate yields one row per group, joined back by key.  Unlike a window over
the group, no task has to hold a whole (possibly huge) group.  The per-group
table is written once, so Spark knows its size: it broadcasts a small one and shuffles
otherwise, where adaptive execution splits hot groups (``operators.joins.stats_join``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.functions.scoring import band_half_open
from perfscore.functions.stats import Z_EPS, pearson, zscore
from perfscore.operators.joins import stats_join

GroupCols = str | Sequence[str]


def _cols(group_cols: GroupCols) -> list[str]:
    return [group_cols] if isinstance(group_cols, str) else list(group_cols)


def group_stats(df: DataFrame, value: str, group_cols: GroupCols) -> DataFrame:
    """One row per group: n, mean, sample std of ``value`` (NULL keys dropped)."""
    keys = _cols(group_cols)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return (df.where(cond).groupBy(*keys)
            .agg(F.count(value).alias("_n"), F.avg(value).alias("_mean"),
                 F.stddev_samp(value).alias("_std")))


def zscore_within(df: DataFrame, value: str, group_cols: GroupCols = "channel_name",
                  out: str = "z", eps: float = Z_EPS) -> DataFrame:
    """Add ``out`` = (x - group mean) / (group sample std + eps)."""
    keys = _cols(group_cols)
    joined = stats_join(df, group_stats(df, value, keys), keys)
    return joined.withColumn(out, zscore(value, "_mean", "_std", eps)).drop("_mean", "_std")


def group_mean(df: DataFrame, value: str, group_cols: GroupCols = "channel_name",
               out: str = "group_mean") -> DataFrame:
    """Add the mean of ``value`` over the row's group."""
    keys = _cols(group_cols)
    stats = group_stats(df, value, keys).select(*keys, "_n", F.col("_mean").alias(out))
    return stats_join(df, stats, keys)


def pearson_pair(df: DataFrame, score: str, raw: str, norm: str, digits: int = 6) -> DataFrame:
    """Correlation of the score with raw and with normalised performance."""
    row = df.agg(pearson(score, raw).alias("raw"), pearson(score, norm).alias("norm"))
    return row.select(F.explode(F.array(
        F.struct(F.lit("raw").alias("target"), F.round("raw", digits).alias("corr")),
        F.struct(F.lit("within_group").alias("target"), F.round("norm", digits).alias("corr")),
    )).alias("r")).select("r.*")


def score_bands(df: DataFrame, score: str, norm: str, digits: int = 6) -> DataFrame:
    """Bands ``[0,5) … [15,20)``: n and mean normalised performance.

    Empty bands do not appear; a score of exactly 20 is in no band.
    """
    # Aggregate first, drop the NULL band after: filtering before the aggregate
    # lets Catalyst push the whole score expression into the scans again.
    return (df.select(band_half_open(score).alias("band"), F.col(norm))
            .groupBy("band")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(norm), digits).alias("mean_z"))
            .where(F.col("band").isNotNull()))


def score_summary(df: DataFrame, score: str, digits: int = 6) -> DataFrame:
    """Min, max, mean and exact median (distributed, see operators.quantiles)."""
    from perfscore.operators.quantiles import exact_median
    med = exact_median(df, score).select("median").scalar()
    return df.agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"),
                  F.round(F.avg(score), digits).alias("mean_score"),
                  F.round(med, digits).alias("median_score"))


def flag_means(df: DataFrame, flags: dict, value, suffixes=None) -> DataFrame:
    """Per flag: mean of each value on rows with and without the flag, in one scan.

    ``value`` is a column name or a list of names.  One global aggregate
    computes every conditional mean (no row multiplication before the
    shuffle); the one-row result is then unpivoted to one row per flag.
    Columns are ``mean_with``/``mean_without`` for one value, else suffixed
    with ``_<value>``.
    """
    values = [value] if isinstance(value, str) else list(value)
    sfx = suffixes or ([""] if isinstance(value, str) else [f"_{v}" for v in values])
    aggs = []
    for i, (name, cond) in enumerate(flags.items()):
        on = F.coalesce(cond, F.lit(False))
        aggs.append(F.count_if(on).alias(f"__n{i}"))
        for j, v in enumerate(values):
            aggs.append(F.avg(F.when(on, F.col(v))).alias(f"__on{i}_{j}"))
            aggs.append(F.avg(F.when(~on, F.col(v))).alias(f"__off{i}_{j}"))
    row = df.agg(*aggs)
    structs = []
    for i, name in enumerate(flags):
        fields = [F.lit(name).alias("feature"), F.col(f"__n{i}").alias("n_with")]
        for j, sx in enumerate(sfx):
            fields += [F.col(f"__on{i}_{j}").alias(f"mean_with{sx}"),
                       F.col(f"__off{i}_{j}").alias(f"mean_without{sx}")]
        structs.append(F.struct(*fields))
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _lift(with_col: str, without_col: str, digits: int | None):
    return F.try_divide(with_col, without_col) if digits is None else F.round(F.try_divide(with_col, without_col), digits)


def _diff(with_col: str, without_col: str, digits: int | None):
    diff = F.col(with_col) - F.col(without_col)
    return diff if digits is None else F.round(diff, digits)


def feature_lift(df: DataFrame, flags: dict, value: str, digits: int | None = 6) -> DataFrame:
    """Mean with the feature over mean without it (cross-group multiplier); ``digits=None``: not rounded."""
    m = flag_means(df, flags, value)
    return m.select("feature", "n_with", _lift("mean_with", "mean_without", digits).alias("lift"))


def feature_diff(df: DataFrame, flags: dict, value: str, digits: int | None = 6) -> DataFrame:
    """Mean with the feature minus mean without it (within-group effect); ``digits=None``: not rounded."""
    m = flag_means(df, flags, value)
    return m.select("feature", "n_with", _diff("mean_with", "mean_without", digits).alias("diff"))


def confound_flips(df: DataFrame, flags: dict, raw: str, norm: str, digits: int = 6) -> DataFrame:
    """Features whose direction differs between raw lift and within-group diff (one scan)."""
    m = flag_means(df, flags, [raw, norm], suffixes=["_raw", "_norm"])
    flipped = (_lift("mean_with_raw", "mean_without_raw", None) > 1) != (
        _diff("mean_with_norm", "mean_without_norm", None) > 0)  # decided before rounding
    return m.select("feature", _lift("mean_with_raw", "mean_without_raw", digits).alias("lift"),
                    _diff("mean_with_norm", "mean_without_norm", digits).alias("diff"), flipped.alias("flipped"))


def positive_in_both(diff: DataFrame, weights: DataFrame) -> DataFrame:
    """Features positive in the mean difference and in the ridge weights."""
    return (diff.join(weights, "feature")
            .where((F.col("diff") > 0) & (F.col("weight") > 0)))


def top_k(df: DataFrame, order_col: str, k: int, tie: str = "video_id",
          ascending: bool = False) -> DataFrame:
    """k rows by ``order_col`` with a total order (tie broken by ``tie``)."""
    v = no_nan(order_col, df)
    return df.orderBy(v.asc_nulls_last() if ascending else v.desc_nulls_last(), F.col(tie).asc()).limit(k)


def no_nan(col: str, df: DataFrame) -> F.Column:
    """The column with NaN as NULL, so that both rank last."""
    floating = dict(df.dtypes)[col] in ("float", "double")
    return F.when(~F.isnan(col), F.col(col)) if floating else F.col(col)


def shorten(col: str, n: int, suffix: str):
    c = F.col(col)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(suffix))).otherwise(c)
