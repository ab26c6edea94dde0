"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots of one block each.  A source of weight w releases its block
i (from 1) at slot floor((i - 1) / w) and must place it by slot ceil(i / w); the
earliest deadline among the released blocks takes each slot.  At every slot a
source then holds less than one block more or less than its weight's share.

Weights are taken exactly (as fractions), however many sources there are and however
small their targets; only a ``period`` that the caller asks for rounds them, to whole
shares of it.  The driver works the schedule out slot by slot, one per block of the
mix, and writes it in chunks to a table that rows then look their places up in: its
time grows with the blocks (a heap step each), its memory with the sources alone.

Defined results for odd input: a null source is a source of its own; null and
repeated doc_ids are rows like others (repeated rows get places of their own, ties
in undefined but gapless order); an empty table gives an empty table; source names
outside ``weights`` and weights that are not positive raise an error; columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import batched, islice
from math import gcd, isfinite, lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfscore.llm.common import boxed, ranked, unboxed
from perfscore.session import scratch_path

#: More sources than this are a mistake of the caller's (the schedule is held by the driver).
MAX_SOURCES = 100_000
PLACES = ("epoch", "block", "release", "deadline", "slot", "position")


#: Blocks of the schedule that the driver holds at a time.
CHUNK = 1 << 17
LATEST = (1 << 63) - 1
SCHEDULE = T.StructType([T.StructField("_s", T.LongType()), T.StructField("block", T.LongType()),
                         T.StructField("slot", T.LongType()), T.StructField("release", T.LongType()),
                         T.StructField("deadline", T.LongType())])


def exact_shares(weights: dict) -> dict:
    """Whole shares in exactly the weights' proportions."""
    if odd := [s for s, w in weights.items() if not isfinite(w) or w <= 0]:
        raise ValueError(f"target weights must be positive: {odd[:5]}")
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = gcd(*whole.values())
    return {s: w // common for s, w in whole.items()}


def shares_of(weights: dict, period: int) -> dict:
    """Whole shares (at least 1 each) that sum up to the period, by largest remainders."""
    period = max(period, len(weights))
    total = float(sum(weights.values()))
    ideal = {s: w / total * period for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in ideal.items()}
    order = sorted(ideal, key=lambda s: (shares[s] - ideal[s], str(s)))
    left = period - sum(shares.values())
    for s in order[:max(0, left)]:
        shares[s] += 1
    for _ in range(-left):  # many tiny sources: the ones furthest above their ideal give way
        s = max((s for s in order if shares[s] > 1), key=lambda s: shares[s] - ideal[s])
        shares[s] -= 1
    return shares


def pfair(shares: dict) -> Iterator[tuple[int, int, int, int, int]]:
    """Source (its place in the order of names), block from 0, slot, release and deadline, slot by slot without end."""
    period = sum(shares.values())
    own = [shares[s] for s in sorted(shares, key=str)]
    waiting = [(0, k, 0) for k in range(len(own))]  # release, source, block
    ready: list[tuple[int, int, int, int]] = []  # deadline, source, block, release
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            release, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // own[k]), k, i, release))
        deadline, k, i, release = heapq.heappop(ready)
        assert deadline > t, "weights that sum up to one are always feasible"
        yield k, i, t, release, deadline
        heapq.heappush(waiting, ((i + 1) * period // own[k], k, i + 1))
        t += 1


def pfair_slots(shares: dict) -> dict[object, list[int]]:
    """The slots of each source's blocks over one period, by earliest deadline first."""
    names = sorted(shares, key=str)
    slots: dict[object, list[int]] = {s: [] for s in names}
    for k, _, t, _, _ in islice(pfair(shares), sum(shares.values())):
        slots[names[k]].append(t)
    return slots


def mix_blocks(rows: list[int], shares: dict, block_docs: int, stopping: str) -> Iterator[tuple[int, int, int, int, int]]:
    """The schedule up to the end of the mix; ``rows`` in the order of the sources' names.

    ``all_exhausted`` goes on until each source has given every row once; sources
    that end sooner begin anew.  ``first_exhausted`` ends before the first block that
    a source cannot fill, so that no row is given twice.
    """
    if stopping == "all_exhausted":
        last = [-(-n // block_docs) - 1 for n in rows]
        left = len(rows)
        for placed in pfair(shares):
            yield placed
            left -= placed[1] == last[placed[0]]
            if not left:
                return
    elif stopping == "first_exhausted":
        for placed in pfair(shares):
            if placed[1] == rows[placed[0]] // block_docs:
                return
            yield placed
    else:
        raise ValueError(f"unknown stopping rule {stopping!r}")


def _write_schedule(spark: SparkSession, schedule: Iterator, sources: int) -> tuple[DataFrame, list[int]]:
    """The schedule as a table under the shared folder, and each source's number of blocks."""
    path, blocks = scratch_path(spark, "schedule"), [0] * sources
    for chunk in batched(schedule, CHUNK):
        for k, i, *_ in chunk:
            blocks[k] = i + 1
        s, block, slot, release, deadline = zip(*chunk)
        deadline = [min(d, LATEST) for d in deadline]  # of next to no weight
        part = pa.table([pa.array(c, pa.int64()) for c in (s, block, slot, release, deadline)], SCHEDULE.names)
        spark.createDataFrame(part, SCHEDULE).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(SCHEDULE).parquet(path) if any(blocks) else spark.createDataFrame([], SCHEDULE), blocks


def temperature_weights(rows: dict, exponent: float) -> dict:
    """Targets that flatten the sources' own sizes: proportional to rows ** exponent."""
    return {s: n ** exponent for s, n in rows.items()}


def mix_sources(docs: DataFrame, weights: dict | None = None, *, exponent: float = 0.8, block_docs: int = 16,
                period: int | None = None, stopping: str = "all_exhausted", source: str = "source",
                key: str = "doc_id") -> DataFrame:
    """Rows of the mix with their places: epoch, block, release, deadline, slot, position (long).

    ``weights`` gives each source's target (any scale); without it targets follow
    ``temperature_weights``.  With a ``period`` they are rounded to whole shares of it,
    at least one each; without it they are met exactly.  A row of a source that begins anew appears once per epoch.
    Positions count from 0 without a gap; every slot holds ``block_docs`` of them.
    Within a source, rows stand in the order of a hash of ``key``.
    """
    spark = docs.sparkSession
    rows_in = boxed(docs, F.col(source).alias("_name"), F.col(key).alias("_key"))
    counted = rows_in.groupBy(F.col("_name").alias("s")).count().limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = {r["s"]: r["count"] for r in counted}
    weights = weights or temperature_weights(rows, exponent)
    if missing := sorted(set(map(str, rows)) - set(map(str, weights))):
        raise ValueError(f"no target weight for the sources {missing[:5]}")
    weights = {s: weights[s] for s in rows}
    names = sorted(rows, key=str)
    shares = (shares_of(weights, period) if period else exact_shares(weights)) if rows else {}
    schedule, blocks = _write_schedule(
        spark, mix_blocks([rows[s] for s in names], shares, block_docs, stopping) if rows else iter(()), len(names))
    sides = spark.createDataFrame([(s, k, rows[s], blocks[k]) for k, s in enumerate(names)],
                                  "_source string, _s long, _rows long, _blocks long")

    order = F.xxhash64(F.lit("mix"), F.col("_key"))
    placed = ranked(rows_in.withColumn("_order", order), ["_name"], ["_order", "_key"], F.col("_order"), "_rank", 20_000)
    # one row per source: bounded by MAX_SOURCES, not by the rows
    joined = placed.join(F.broadcast(sides), placed["_name"].eqNullSafe(sides["_source"]))
    last = F.floor((F.col("_blocks") * block_docs - 1 - F.col("_rank")) / F.col("_rows")).cast("long")
    used = joined.where(F.col("_blocks") * block_docs > F.col("_rank")).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    index = F.col("epoch") * F.col("_rows") + F.col("_rank")

    # the schedule is broadcast or, beyond Spark's threshold, joined by shuffle: a block has block_docs rows
    timed = (used
             .withColumn("_index", index)
             .withColumn("block", F.expr(f"_index div {block_docs}"))
             .join(schedule, ["_s", "block"])
             .withColumn("position", F.expr(f"slot * {block_docs} + _index % {block_docs}")))
    return unboxed(timed, docs.columns, added=PLACES)


def mixed_documents(docs: DataFrame, weights: dict | None = None, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, its files in the order of the schedule."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(options.get("source", "source")).alias("source"),
                        F.col(options.get("key", "doc_id")).alias("key"))
    placed = mix_sources(whole, weights, **{**options, "source": "source", "key": "key"})
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
