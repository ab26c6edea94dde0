"""Ridge fits of all folds from one pass over the rows.

Each task sums the outer products of its rows ``[1, x, y]`` per cell (a fold or a training
split); the shuffle adds the tasks' matrices row by row.  What reaches the driver is one
matrix per cell, ``(features + 2)²`` numbers however many rows there are.  A fold's training
split is the total minus the fold; means, deviations, the scaler and the ridge solution
all follow from the matrices, so ``k + 1`` fits need no further pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = "cell int, i int, sums array<double>"


def fold_grams(rows: DataFrame, cells: int, width: int, x: Column, y: Column, used: Column,
               varying: Column | None = None, at: int = -1) -> np.ndarray:
    """The matrices ``Σ [1, x, y]ᵀ[1, x, y]`` of each cell, from one pass.

    ``x`` is an array of ``width`` doubles.  ``y`` and ``used`` are arrays with an entry per cell: the row's target
    there, and whether it counts there.  ``varying`` replaces feature ``at`` by a value per cell.
    """
    varies = varying is not None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((cells, width + 2, width + 2))
        for b in batches:
            if not b.num_rows:
                continue
            def wide(name: str, size: int) -> np.ndarray:
                return b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)

            base, target, counts = wide("x", width), wide("y", cells), wide("used", cells).astype(bool)
            other = wide("varying", cells) if varies else None
            for c in range(cells):
                own = counts[:, c]
                if own.any():
                    feats = base[own]
                    if other is not None:
                        feats = feats.copy()
                        feats[:, at] = other[own, c]
                    a = np.column_stack([np.ones(len(feats)), feats, target[own, c]])
                    sums[c] += a.T @ a
        cell, i = np.divmod(np.arange(cells * (width + 2)), width + 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(list(sums.reshape(-1, width + 2)))],
            ["cell", "i", "sums"])

    def total(own: pa.Table) -> pa.Table:
        whole = own.column("sums").combine_chunks().flatten().to_numpy().reshape(own.num_rows, -1).sum(axis=0)
        return pa.table({"cell": own.column("cell")[:1], "i": own.column("i")[:1], "sums": pa.array([whole.tolist()])})

    columns = [x.alias("x"), y.alias("y"), used.alias("used")]
    if varies:
        columns.append(varying.alias("varying"))
    added = rows.select(*columns).mapInArrow(add, CELLS).groupBy("cell", "i").applyInArrow(total, CELLS).toArrow()
    out = np.zeros((cells, width + 2, width + 2))
    for cell, i, sums in zip(*(added.column(c).to_pylist() for c in ("cell", "i", "sums"))):
        out[cell, i] = sums
    return out


def other_cells(grams: np.ndarray) -> np.ndarray:
    """For each cell the matrix of all rows outside it."""
    return grams.sum(axis=0) - grams


@dataclass(frozen=True)
class Linear:
    """``intercept + weights · x`` on unscaled features."""

    intercept: float
    weights: np.ndarray
    scaled: np.ndarray     # weights of the standardised features


def deviations(gram: np.ndarray, scaled_from: int) -> np.ndarray:
    """Population deviation of each feature from ``scaled_from`` on, 1 for those before and for constant ones."""
    n = gram[0, 0]
    var = np.diag(gram)[1:-1] / max(n, 1) - (gram[0, 1:-1] / max(n, 1)) ** 2
    scale = np.diag(gram)[1:-1] / max(n, 1)
    out = np.sqrt(np.maximum(var, 0.0))
    out[var <= 1e-14 * scale] = 0.0  # what rounding leaves of a constant
    out[:scaled_from] = 1.0
    return np.where(out == 0, 1.0, out)


def solve_ridge(gram: np.ndarray, alpha: float, scale: np.ndarray | None = None) -> Linear:
    """Ridge with intercept and penalty ``alpha · ||w||²`` on features divided by ``scale``."""
    n = gram[0, 0]
    width = len(gram) - 2
    scale = np.ones(width) if scale is None else scale
    if n == 0:
        return Linear(0.0, np.zeros(width), np.zeros(width))
    mean = gram[0, 1:] / n
    spread = gram[1:, 1:] - n * np.outer(mean, mean)
    inner = spread[:-1, :-1] / np.outer(scale, scale) + alpha * np.eye(width)
    scaled = np.linalg.lstsq(inner, spread[:-1, -1] / scale, rcond=None)[0] if alpha == 0 else \
        np.linalg.solve(inner, spread[:-1, -1] / scale)
    weights = scaled / scale
    return Linear(float(mean[-1] - weights @ mean[:-1]), weights, scaled)


def with_predictions(rows: DataFrame, models: list[Linear], fold: str, x: Column) -> DataFrame:
    """Add each row's ``prediction`` by its fold's model (a table of one row per fold)."""
    table = rows.sparkSession.createDataFrame(
        [(f, m.intercept, m.weights.tolist()) for f, m in enumerate(models)], f"{fold} long, _b double, _w array<double>")
    joined = rows.join(F.broadcast(table), fold)  # a row per fold; by key, each fold's rows would meet in one task
    dot = F.aggregate(F.zip_with(x, F.col("_w"), lambda a, w: a * w), F.col("_b"), lambda s, v: s + v)
    return joined.withColumn("prediction", dot).drop("_b", "_w")
