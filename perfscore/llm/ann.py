"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner products are nearest neighbours once each vector gets one more
component, sqrt(M^2 - |x|^2) with M the greatest length (and 0 for a query scaled to
length M).  Vectors are split into classes of about equal length, each with an M and
buckets of its own, so that long vectors do not squeeze short ones together; a query
probes all classes.  Each table hashes a vector to floor((a.x + b) / w) for a few Gaussian a.
A query visits its own bucket and perturbed ones, in the order of their estimated
success: perturbation sets are ordered by the expected squared distances to the bucket
walls, and mapped to each query's own walls.  The candidates of all tables are merged
and ranked by the exact inner product of the original vectors.

Buckets are dealt to cells of bounded size; a bucket beyond that is split over several
cells, and a query goes to all of them.  A cell returns each query's best ``k`` alone.
Queries that find fewer than ``k``, and fewer than there are, are compared with all
vectors, in blocks.

Defined results for odd input: vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do rows without a vec_id; of rows that repeat a
vec_id the smallest vector counts; vectors of different lengths are not compared; a
query gets fewer than ``k`` only if there are fewer other vectors; ties go to the smaller
vec_id; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfscore.llm.common import in_slices, materialize, ship_package


#: Pairs of query and candidate that a task compares at a time.
PAIRS = 200_000


@dataclass(frozen=True)
class Tables:
    """Hash tables, hashes of a table, bucket width (in a class's greatest lengths), buckets a query visits of a class.

    ``probes`` may differ by table: a vector that two tables offer is compared twice, so one table is
    visited widely and the other adds what lies beyond its walls.
    """

    tables: int = 2
    hashes: int = 6
    width: float = 2.3
    probes: int | tuple[int, ...] = (280, 8)
    seed: int = 11
    cell_rows: int = 20_000

    def probes_of(self, table: int) -> int:
        return self.probes if isinstance(self.probes, int) else self.probes[table]


def probe_sets(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of wall ranks (0: the nearest wall) in the order of their expected scores.

    Ranks j and 2m - 1 - j are the two walls of one hash, so no set holds both.
    """
    m = hashes
    rank = np.arange(1, 2 * m + 1)
    near = rank * (rank + 1) / (4 * (m + 1) * (m + 2))
    mirror = 2 * m + 1 - rank
    far = 1 - mirror / (m + 1) + mirror * (mirror + 1) / (4 * (m + 1) * (m + 2))
    z = np.where(rank <= m, near, far)
    out: list[tuple[int, ...]] = [()]
    heap = [(z[0], (0,))]
    while heap and len(out) < probes:
        score, s = heapq.heappop(heap)
        if not any(2 * m - 1 - j in s for j in s):
            out.append(s)
        if (last := s[-1]) + 1 < 2 * m:
            heapq.heappush(heap, (score - z[last] + z[last + 1], (*s[:-1], last + 1)))
            heapq.heappush(heap, (score + z[last + 1], (*s, last + 1)))
    return out


def length_classes(octaves: list[tuple[float, float]]) -> list[float]:
    """Greatest length of each class, descending, from each octave's least and greatest length.

    An octave joins the class before it while no length falls below half of that class's greatest.
    """
    out: list[float] = []
    for least, most in sorted(octaves, key=lambda o: -o[1]):
        if not out or least < out[-1] / 2:
            out.append(most * (1 + 1e-12))
    return out


def _bucket_keys(cells: np.ndarray, table: int, dim: int, kind: np.ndarray | int = 0) -> np.ndarray:
    """One 64-bit key for each row of hash values; vectors of other dimensions or length classes share none."""
    key = np.full(len(cells), (dim << 16) + table + 1, np.uint64) + (np.uint64(1 << 48) * np.asarray(kind, np.uint64))
    for column in cells.T:
        key = (key ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _hash(spec: Tables, classes: dict[int, list[float]]):
    """Per vector: its bucket in each table; per query: the buckets it visits in each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = [spec.probes_of(t) for t in range(spec.tables)]
        sets = probe_sets(spec.hashes, max(each))
        longest = max(map(len, sets))
        members = np.array([[*s, *[-1] * (longest - len(s))] for s in sets])
        for b in in_slices(batches, max(1, 10_000 // max(map(len, classes.values()), default=1))):
            column = b.column("v")
            at, values = column.offsets.to_numpy(), column.values.to_numpy()  # offsets of the whole values
            dims = np.diff(at)
            asks = b.column("is_query").to_numpy(zero_copy_only=False)
            own = np.zeros((len(dims), spec.tables), np.int64)
            visits: list = [None] * len(dims)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                x = values[at[rows][:, None] + np.arange(dim)]
                length = np.sqrt((x * x).sum(1))
                bounds = np.array(classes[dim])
                kind = np.maximum(0, (bounds[:, None] >= length).sum(0) - 1)
                most = bounds[kind]
                rng = np.random.default_rng([spec.seed, dim])
                a = rng.standard_normal((spec.tables, spec.hashes, dim + 1))
                shift = rng.random((spec.tables, spec.hashes))
                extra = np.sqrt(np.maximum(0, most * most - length * length))
                ask = rows[asks[rows]]
                q = x[asks[rows]] / length[asks[rows], None]
                probed = []
                for t in range(spec.tables):
                    place = (x @ a[t, :, :dim].T + extra[:, None] * a[t, :, dim]) / (spec.width * most)[:, None] + shift[t]
                    own[rows, t] = _bucket_keys(np.floor(place), t, dim, kind)
                    place = q @ a[t, :, :dim].T / spec.width + shift[t]
                    base = np.floor(place).astype(np.int64)
                    visited = _visits(base, place - base, members[:each[t]], t, dim, len(bounds))
                    probed.append(visited.reshape(len(ask), visited.shape[1] * visited.shape[2]))
                for row, keys in zip(ask, np.concatenate(probed, axis=1)):
                    visits[row] = keys
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), column, pa.array(list(own), pa.list_(pa.int64())),
                 pa.array(visits, pa.list_(pa.int64()))], ["vec_id", "v", "own", "visits"])
    return run


def _visits(base: np.ndarray, inside: np.ndarray, members: np.ndarray, table: int,
            dim: int, kinds: int) -> np.ndarray:
    """Keys of the buckets that each query visits, best first (query, class, bucket)."""
    queries, m = base.shape
    walls = np.concatenate([inside, 1 - inside], axis=1)  # to the lower and to the upper wall
    order = np.argsort(walls, axis=1, kind="stable")
    out = np.empty((queries, kinds, len(members)), np.int64)
    for p, own in enumerate(members):
        cell = base.copy()
        for rank in own[own >= 0]:
            wall = order[:, rank]
            cell[np.arange(queries), wall % m] += np.where(wall < m, -1, 1)
        for kind in range(kinds):
            out[:, kind, p] = _bucket_keys(cell, table, dim, kind)
    return out


def _best(k: int):
    """Per cell: each query's k best among the buckets that it visits there."""
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64),
                             "score": np.empty(0, np.float64)})
        if rows.empty or asked.empty:
            return none
        rows = rows.sort_values(["bucket", "vec_id"])
        vec_id, bucket = rows["vec_id"].to_numpy(), rows["bucket"].to_numpy()
        visits = [np.asarray(x) for x in asked["buckets"]]
        who = np.repeat(np.arange(len(asked)), [len(x) for x in visits])
        what = np.concatenate(visits)
        order = np.argsort(what, kind="stable")
        who, what = who[order], what[order]
        vectors = list(rows["v"])
        queries, query_id = list(asked["v"]), asked["query_id"].to_numpy()
        names, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(bucket))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        floor = np.full(len(asked), -np.inf)  # what a query's k-th best of one bucket reaches
        for name, lo, hi in zip(names, first, ends):
            own = who[np.searchsorted(what, name):np.searchsorted(what, name, "right")]
            own = own[[len(queries[i]) == len(vectors[lo]) for i in own]] if len(own) else own
            v = np.stack(vectors[lo:hi]) if len(own) else None
            step = max(1, PAIRS // (hi - lo))
            for at in range(0, len(own), step):
                q = own[at:at + step]
                a = np.stack([queries[i] for i in q])
                s = a @ v.T
                s[query_id[q][:, None] == vec_id[lo:hi][None, :]] = -np.inf
                slack = 1e-9 * (1 + np.abs(s).max(initial=0, where=np.isfinite(s)))
                if hi - lo > k:
                    floor[q] = np.maximum(floor[q], np.partition(s, -k, axis=1)[:, -k])
                i, j = np.nonzero((s >= floor[q][:, None] - slack) & np.isfinite(s))
                found.append(_top(q[i], vec_id[lo + j], (a[i] * v[j]).sum(1), k))  # exactly, pair by pair
        if not found:
            return none
        q, c, s = _top(*(np.concatenate(x) for x in zip(*found)), k)
        return pd.DataFrame({"query_id": query_id[q], "vec_id": c, "score": s})
    return run


def _top(q: np.ndarray, c: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best different candidates; ties to the smaller one."""
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, s = q[new], c[new], s[new]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], c[keep], s[keep]


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id (long) and v (array of double) of the rows that take part, one per vec_id."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(usable & F.exists("v", lambda x: x != 0.0))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, spec: Tables | None = None) -> DataFrame:
    """Per query (rows for which ``is_query`` of vec_id holds): query_id, rank, vec_id, score."""
    spec = spec or Tables()
    ship_package(vectors.sparkSession)
    clean = materialize(clean_vectors(vectors).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    length = F.greatest(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-300))
    # one row per dimension and octave of lengths
    stats = (clean.select(F.size("v").alias("dim"), length.alias("length"))
             .groupBy("dim", F.floor(F.log2("length")).alias("octave"))
             .agg(F.min("length").alias("least"), F.max("length").alias("most"), F.count(F.lit(1)).alias("n")).collect())
    classes = {d: length_classes([(r["least"], r["most"]) for r in stats if r["dim"] == d]) for d in {r["dim"] for r in stats}}
    n_rows = {d: sum(r["n"] for r in stats if r["dim"] == d) for d in classes}
    cells = max(1, -(-sum(n_rows.values()) // spec.cell_rows))
    hashed = materialize(clean.mapInArrow(
        _hash(spec, classes), "vec_id long, v array<double>, own array<long>, visits array<long>"), "hashed")

    # a cell meets the queries in blocks, so that neither side of a task grows with the input
    blocks = max(1, -(-hashed.where("visits is not null").count() // spec.cell_rows))
    placed = hashed.select("vec_id", "v", F.explode("own").alias("bucket"))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "splits", F.ceil(F.col("n") / spec.cell_rows).cast("int"))

    def cell(salt):
        def pair(a, b):
            return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

        small = pair(F.lit(0), F.pmod(F.xxhash64("bucket"), F.lit(cells * spec.tables)))
        return F.when(F.col("splits") == 1, small).otherwise(pair(F.col("bucket"), salt))

    split = counts.where("splits > 1").select("bucket", "splits")
    dealt = (placed.join(split, "bucket", "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
             .withColumn("cell", cell(F.pmod(F.xxhash64("vec_id"), F.col("splits"))))
             .withColumn("asks", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select(F.struct("cell.a", "cell.b", "asks").alias("cell"), "bucket", "vec_id", "v"))
    visits = (hashed.where("visits is not null")
              .select(F.col("vec_id").alias("query_id"), F.explode(F.array_distinct("visits")).alias("bucket"))
              .join(counts, "bucket")  # buckets that hold nothing are not visited
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
              .withColumn("cell", cell(F.col("salt")))
              .withColumn("cell", F.struct("cell.a", "cell.b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("asks")))
              .groupBy("query_id", "cell").agg(F.collect_list("bucket").alias("buckets")))
    asked = visits.join(hashed.where("visits is not null").select(F.col("vec_id").alias("query_id"), "v"), "query_id")
    best = dealt.groupBy("cell").cogroup(asked.groupBy("cell")).applyInPandas(
        _best(k), "query_id long, vec_id long, score double")
    found = materialize(_ranked(best, k), "found")

    asks = hashed.where("visits is not null").select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"))
    others = vectors.sparkSession.createDataFrame([(d, n - 1) for d, n in n_rows.items()], "dim int, others long")
    short = materialize(
        asks.join(found.groupBy("query_id").count(), "query_id", "left").join(others, "dim")
        .where(F.coalesce("count", F.lit(0)) < F.least("others", F.lit(k))).select("query_id", "v", "dim"), "short")
    n_short = short.count()
    if not n_short:
        return found
    whole = _best_of_all(hashed, short, k, cells, -(-n_short // spec.cell_rows))
    return found.join(short, "query_id", "left_anti").unionByName(whole)


def _best_of_all(hashed: DataFrame, short: DataFrame, k: int, cells: int, parts: int) -> DataFrame:
    """The k best of all vectors for each of the given queries: each block of queries meets each of vectors."""
    def block(column, n):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = (hashed.select("vec_id", "v", F.size("v").cast("long").alias("bucket"))
            .join(short.select(F.col("dim").cast("long").alias("bucket")).distinct(), "bucket", "left_semi")
            .withColumn("part", each(parts))
            .select(F.struct(block("vec_id", cells).alias("a"), F.col("part").alias("b")).alias("cell"),
                    "bucket", "vec_id", "v"))
    asked = (short.withColumn("part", each(cells))
             .select("query_id", F.struct(F.col("part").alias("a"), block("query_id", parts).alias("b")).alias("cell"),
                     F.array(F.col("dim").cast("long")).alias("buckets"), "v"))
    return _ranked(rows.groupBy("cell").cogroup(asked.groupBy("cell")).applyInPandas(
        _best(k), "query_id long, vec_id long, score double"), k)


def _ranked(best: DataFrame, k: int) -> DataFrame:
    """The k best of what the cells returned."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
