"""Exploration aggregates.

Several-column reports are computed in one scan: either one global aggregate
whose single row is unpivoted, or an ``unpivot`` followed by one ``groupBy``
(partial aggregation runs before the shuffle, so only distinct keys move).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.functions.scoring import band_names, band_right_closed
from perfscore.operators.joins import small_side
from perfscore.operators.quantiles import exact_quantiles
from perfscore.operators.stats import no_nan, top_k


def _explode_structs(row: DataFrame, structs) -> DataFrame:
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def profile_columns(df: DataFrame) -> DataFrame:
    """Column name, type and non-NULL count of every column; one scan."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(F.col(f"`{c}`")).alias(f"__nn_{i}") for i, c in enumerate(df.columns)])
    structs = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col("__rows").alias("n_rows"), F.col(f"__nn_{i}").alias("non_null"))
               for i, f in enumerate(df.schema.fields)]
    return _explode_structs(row, structs)


def head_rows(df: DataFrame, n: int = 5, order: str = "video_id") -> DataFrame:
    """First ``n`` rows in key order (a top-k, not a scan of everything to the driver)."""
    return df.orderBy(F.col(order)).limit(n)


def value_counts_multi(df: DataFrame, cols: Sequence[str], order: str | None = None) -> DataFrame:
    """Frequency of every value of several columns (NULL values dropped).

    ``order='frequency'`` sorts each column's values by count (descending,
    ties by value); ``order='value'`` by value; ``None`` leaves rows unordered.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value")
    out = (long.where(F.col("value").isNotNull())
           .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    if order == "frequency":
        return out.orderBy("feature", F.col("n").desc(), "value")
    if order == "value":
        return out.orderBy("feature", "value")
    return out


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[fn(c).alias(f"n_{c}") for c in cols])


def describe_exact(df: DataFrame, col: str, digits: int = 9) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles (linear), max.

    Quartiles come from the distributed exact quantile (sorted ranks), entering
    the one-row result as a scalar subquery.
    """
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
    qs = q.select(F.struct("p25", "p50", "p75")).scalar()
    row = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                 F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"))
    r = lambda c: F.round(c, digits)
    return row.select("count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"),
                      r(F.col("min")).alias("min"), r(qs["p25"]).alias("p25"),
                      r(qs["p50"]).alias("p50"), r(qs["p75"]).alias("p75"),
                      r(F.col("max")).alias("max"))


def histogram_bins(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], the last bin closed; empty bins omitted.

    Bounds come from a scalar subquery (one small job), not a cross join.
    """
    vals = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))
    bounds = vals.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = hi - lo
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - lo) / width * bins), F.lit(bins - 1)))
    return (vals.select(b.cast("int").alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))


def boxplot_stats(df: DataFrame, value: str, group: str, digits: int = 9) -> DataFrame:
    """Per group: quartiles, whiskers inside 1.5 IQR, number of outliers."""
    v = F.col(value)
    keyed = df.where(F.col(group).isNotNull() & no_nan(value, df).isNotNull())
    quart = exact_quantiles(keyed, value, [0.25, 0.5, 0.75], [group], ["q1", "median", "q3"])
    quart = small_side(quart.drop("n"))
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - 1.5 * iqr
    hi_fence = F.col("q3") + 1.5 * iqr
    inside = (v >= lo_fence) & (v <= hi_fence)
    out = (keyed.join(quart, group)
           .groupBy(group, "q1", "median", "q3")
           .agg(F.min(F.when(inside, v)).alias("whisker_low"),
                F.max(F.when(inside, v)).alias("whisker_high"),
                F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n")))
    r = lambda c: F.round(F.col(c), digits).alias(c)
    return out.select(group, "n", r("q1"), r("median"), r("q3"), r("whisker_low"),
                      r("whisker_high"), "n_outliers")


def top_formatted(df: DataFrame, k: int = 20, title_chars: int = 50) -> DataFrame:
    """Top k by performance with thousands separators and four decimals."""
    top = top_k(df, "performance_score", k)
    return top.select(
        "video_id",
        F.when(F.length("title") > title_chars,
               F.concat(F.substring("title", 1, title_chars), F.lit("..."))).otherwise(F.col("title"))
        .alias("title"),
        "channel_name", "niche",
        F.format_number("view_count", 0).alias("view_count"),
        F.format_number("subscriber_count", 0).alias("subscriber_count"),
        F.format_string("%.4f", "performance_score").alias("performance_score"))


def category_encode(col: str, mapping: dict) -> F.Column:
    """Category → number from a fixed mapping; unmapped → NULL."""
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, F.lit(v)) if out is None else out.when(F.col(col) == k, F.lit(v))
    return out


def top_bottom_k(df: DataFrame, col: str, k: int, tie: str = "video_id") -> DataFrame:
    """k largest and k smallest rows (ties by ``tie``), labelled by side."""
    top = top_k(df, col, k, tie).withColumn("side", F.lit("top"))
    bottom = top_k(df, col, k, tie, ascending=True).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def seed_key(id_col: str, seed: int) -> F.Column:
    """Repeatable pseudo-random order, independent of partitioning and engine."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "video_id") -> DataFrame:
    """n rows in seeded order (fewer if the input is smaller)."""
    return df.orderBy(seed_key(id_col, seed), F.col(id_col)).limit(n)


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count of each column that has any, plus the total; one scan."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n_{i}")
                   for i, c in enumerate(df.columns)])
    total = None
    for i in range(len(df.columns)):
        total = F.col(f"__n_{i}") if total is None else total + F.col(f"__n_{i}")
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"__n_{i}").alias("n_null"))
               for i, c in enumerate(df.columns)]
    structs.append(F.struct(F.lit("__total__").alias("column_name"), total.alias("n_null")))
    long = _explode_structs(row, structs)
    return long.where((F.col("n_null") > 0) | (F.col("column_name") == "__total__"))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows after the first per key value (NULLs equal each other)."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_distinct(F.col(k)).alias(f"__d_{i}") for i, k in enumerate(keys)],
                 *[F.max(F.col(k).isNull().cast("int")).alias(f"__z_{i}") for i, k in enumerate(keys)])
    structs = [F.struct(F.lit(k).alias("key"),
                        (F.col("__rows") - F.col(f"__d_{i}") - F.coalesce(F.col(f"__z_{i}"), F.lit(0)))
                        .alias("n_duplicates"))
               for i, k in enumerate(keys)]
    return _explode_structs(row, structs)


def value_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[a for c in cols for a in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


def flag_stats(df: DataFrame, flags: Sequence[str], digits: int = 6) -> DataFrame:
    """Count and percent true of boolean columns; one scan."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c)).alias(f"__t_{i}") for i, c in enumerate(flags)])
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"__t_{i}").alias("n_true"),
                        F.round(F.try_divide(F.col(f"__t_{i}") * 100.0, F.col("__rows")), digits).alias("pct_true"))
               for i, c in enumerate(flags)]
    return _explode_structs(row, structs)


def mean_by_feature(df: DataFrame, cols: Sequence[str], value: str, digits: int = 9) -> DataFrame:
    """Mean of ``value`` for each value of each column; one unpivot + one groupBy."""
    long = df.select(F.col(value), *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [value], list(cols), "feature", "level")
    return (long.where(F.col("level").isNotNull()).groupBy("feature", "level")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), digits).alias("mean_value")))


def importance_rank(effects: DataFrame, value: str = "diff", digits: int = 6) -> DataFrame:
    """Rank features by effect; flag those at or above the median effect (both before rounding).

    ``effects`` has one row per feature (a few dozen).  It is materialised
    once; the median and the rank window then run over that tiny table only.
    """
    from pyspark.sql import Window
    effects = small_side(effects)
    med = effects.select(F.median(value)).scalar()
    w = Window.orderBy(F.col(value).desc(), F.col("feature"))
    return effects.select("feature", F.round(value, digits).alias(value),
                          F.rank().over(w).alias("rank"),
                          (F.col(value) >= med).alias("above_median"))


def bands_right_closed(df: DataFrame, score: str, value: str, digits: int = 9) -> DataFrame:
    """``(lo,hi]`` score bands in band order, empty bands kept with n = 0."""
    spark = df.sparkSession
    names = band_names()
    band_list = spark.createDataFrame([(i, b) for i, b in enumerate(names)], "band_order int, band string")
    agg = (df.select(band_right_closed(score).alias("band"), F.col(value)).groupBy("band")
           .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), digits).alias("mean_value"))
           .where(F.col("band").isNotNull()))
    return (band_list.join(F.broadcast(agg), "band", "left")
            .select("band_order", "band", F.coalesce("n", F.lit(0)).alias("n"), "mean_value"))


def band_top_share(df: DataFrame, score: str, value: str, threshold: float,
                   digits: int = 6) -> DataFrame:
    """Per ``(lo,hi]`` band: n, mean, percent of rows at or above ``threshold``."""
    return (df.select(band_right_closed(score).alias("band"), F.col(value)).groupBy("band")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 9).alias("mean_value"),
                 F.round(F.avg((F.col(value) >= threshold).cast("int")) * 100, digits).alias("pct_top"))
            .where(F.col("band").isNotNull()))


def channel_scores(df: DataFrame, group: str, score: str, value: str) -> DataFrame:
    """Per group: mean score, mean performance, count; two decimals; best mean score first, ties by group."""
    return (df.where(F.col(group).isNotNull()).groupBy(group)
            .agg(F.round(F.avg(score), 2).alias("mean_score"),
                 F.round(F.avg(value), 2).alias("mean_performance"),
                 F.count("video_id").alias("video_count"))
            .orderBy(F.desc("mean_score"), group))
