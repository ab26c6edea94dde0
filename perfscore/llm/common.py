"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfscore.session import materialize

#: ASCII white space that separates words (tab to carriage return, and space).
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one input table; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str | Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def split_words(text: Column) -> Column:
    """Words of a text: the non-empty pieces between runs of ASCII white space."""
    return F.filter(F.split(text, WORD_GAP), lambda w: w != F.lit(""))


def boxed(df: DataFrame, *names: str | Column) -> DataFrame:
    """The named columns, and whole rows as the struct ``_all``: no other column can clash."""
    return df.select(*names, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"))


def unboxed(df: DataFrame, columns: list[str], changed: dict[str, Column] | None = None,
            added: Iterable[str] = ()) -> DataFrame:
    """The columns that were boxed, some of them changed, and added ones, which replace clashing ones."""
    changed, added = changed or {}, list(added)
    names = {a.lower() for a in added}
    old = [changed.get(c, F.col("_all")[c]).alias(c) for c in columns if c.lower() not in names]
    return df.select(*old, *added)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_struct(df: DataFrame, value: Column) -> DataFrame:
    """Add a struct's fields as columns, replacing columns of the same names.

    The struct is generated, not projected: filters on its fields stay above it,
    so Catalyst cannot copy costly expressions into them.
    """
    names = df.select(value.alias("v")).select("v.*").columns
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(value)).alias(*names))


def same(left: DataFrame, right: DataFrame, columns: Iterable[str]) -> Column:
    """Null-safe equality of the named columns (still a hash or sort-merge join key)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def in_slices(batches: Iterator, rows: int = 1000) -> Iterator:
    """Arrow batches in smaller ones, so that what is worked out from one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def byte_slices(texts, limit: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of slices of an Arrow string column, of about ``limit`` bytes at most or one row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64").cumsum()
    lo = 0
    while lo < len(sizes):
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(sizes.searchsorted(before + limit, "right")))
        yield lo, hi - lo
        lo = hi


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application).

    Spark's own file distribution carries it, so the executors need no copy of the
    repository and no shared folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def numbered_table(df: DataFrame, name: str) -> DataFrame:
    """Write a (narrow) table with a number ``_row`` for each row and read it back.

    The numbers are fixed by the write, so later stages may rely on them.
    """
    return materialize(df.withColumn("_row", F.monotonically_increasing_id()), name)


def ranked(df: DataFrame, group: list[str], order: list[str], spread: Column, name: str,
           rows_per_part: int = 50_000) -> DataFrame:
    """Add ``name``: a gapless rank from 0 within each group, hot groups split.

    Rows are dealt by (group, salt) and numbered there; the salts' counts are summed
    up to offsets in a table of one row per (group, salt).  The number of salts follows
    from a count, so about ``rows_per_part`` rows meet in one part even if one group
    holds all of them.  ``spread`` (a whole number) must differ between most rows; it,
    ``order`` and ``df`` itself must be deterministic.
    """
    parts = max(1, -(-df.count() // rows_per_part))
    salted = df.withColumn("_salt", F.pmod(spread, F.lit(parts)).cast("int"))
    keys = [*group, "_salt"]
    counts = salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    numbered = salted.withColumn("_in_part", F.row_number().over(inside) - 1)
    cond = F.lit(True)
    for k in keys:
        cond = cond & numbered[k].eqNullSafe(offsets[f"_o_{k}"])
    return (numbered.join(offsets, cond)
            .withColumn(name, (F.col("_before") + F.col("_in_part")).cast("long"))
            .drop("_salt", "_before", "_in_part", *[f"_o_{k}" for k in keys]))


#: Keys that more than one row in so many has are hot: there are never more of them than this.
HOT_SHARE = 20_000


def hot_join(rows: DataFrame, side: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Left join of ``rows`` with ``side`` (one row per key, ``size`` = the key's number of rows).

    Keys that hold more than one row in ``HOT_SHARE`` are at most ``HOT_SHARE`` keys, so their
    side is broadcast and their rows stay where they are; all other rows meet their key in a
    shuffle, in which no key holds more than that share.  Keys compare null-safe; rows
    must be deterministic, as they are read twice.
    """
    side = materialize(side, "side")
    bar = rows.count() // HOT_SHARE
    hot, rest = side.where(F.col(size) > bar), side.where(F.col(size) <= bar)
    added = [c for c in side.columns if c not in keys]

    def found(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *added, F.lit(True).alias("_hit"))
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k].eqNullSafe(right[f"_k_{k}"])
        return left.join(right, cond, "left").drop(*[f"_k_{k}" for k in keys])

    tried = found(rows, F.broadcast(hot))
    cold = tried.where(F.col("_hit").isNull()).drop(*added, "_hit")
    return tried.where("_hit").drop("_hit").unionByName(found(cold, rest).drop("_hit"))


__all__ = ["WORD_GAP", "HOT_SHARE", "boxed", "byte_slices", "hot_join", "in_slices", "let", "materialize", "numbered_table", "ranked", "same", "ship_package", "split_words", "table", "unboxed",
           "whole_text", "with_struct"]
