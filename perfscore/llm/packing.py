"""Best-two-fit packing of token pieces into sequences.

A bin is filled greedily with the longest piece that still fits.  Then its smallest
piece is taken out if two unpacked pieces fill the gap that this leaves more tightly
(and nothing fits what remains).  Pieces are dealt by a hash into groups of bounded
size, each packed by one task from counts of the lengths; a group leaves at most a few
sequences part-filled, so the loss does not grow with the corpus.

Defined results for odd input: a null text is an empty one, whose piece is the end id
alone; repeated rows are packed each (rows alike in doc_id and text are told apart by a
copy number); null doc_ids are documents like others; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import in_slices, materialize, ship_package
from perfscore.llm.tokens import END, crc32, encoder, vocabulary

CAPACITY = 2048
#: Pieces of one packing group.
GROUP = 20_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, after a shorter first one if need be."""
    rest = n % capacity
    starts = ([0] if rest else []) + list(range(rest, n, capacity))
    return [(s, (rest if rest and s == 0 else capacity)) for s in starts]


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins, as lists of lengths, that hold all the lengths (each from 1 to the capacity)."""
    count = np.bincount(lengths, minlength=capacity + 1)
    present = count > 0
    # longest[g]: the greatest unpacked length up to g (0: none)
    longest = np.maximum.accumulate(np.where(present, np.arange(capacity + 1), 0))

    def take(x: int, sign: int) -> None:
        nonlocal longest
        count[x] += sign
        if present[x] != (count[x] > 0):
            present[x] = count[x] > 0
            if sign > 0:
                np.maximum(longest[x:], x, out=longest[x:])
            else:  # lengths from x on that had x as their longest fall back to the one before
                end = x + 1
                above = np.flatnonzero(present[x + 1:])
                end = x + 1 + above[0] if len(above) else capacity + 1
                longest[x:end] = longest[x - 1]

    bins = []
    while longest[capacity]:
        own, gap = [], capacity
        while x := int(longest[gap]):
            take(x, -1)
            own.append(x)
            gap -= x
        if gap and len(own) > 1:
            small = own[-1]
            room = gap + small
            # pairs x >= y of unpacked lengths with the largest sum up to the room
            xs = np.flatnonzero(present[:room])
            if len(xs):
                limit = np.minimum(room - xs, xs)
                single = count[xs] < 2
                ys = longest[np.where(single & (limit == xs), xs - 1, limit)]
                sums = np.where(ys > 0, xs + ys, 0)
                k = int(sums.argmax())
                if sums[k] > small:
                    own.pop()
                    take(small, 1)
                    for z in (int(xs[k]), int(ys[k])):
                        take(z, -1)
                        own.append(z)
        bins.append(own)
    return bins


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_column
        end = np.array([END], np.uint32)
        for b in in_slices(batches, 2500):
            rows = []
            for doc, ids in enumerate(encode(b.column("text"))):
                ids = np.concatenate([ids, end])
                rows += [(doc, k, s, n, crc32(ids[s:s + n])) for k, (s, n) in enumerate(cut(len(ids), capacity))]
            doc, piece, start, length, crc = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def _pack(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        bins = best_two_fit(lengths, capacity)
        # the next row of each length: rows are sorted by falling length
        following = dict(zip(*(x.tolist() for x in np.unique(-lengths, return_index=True))))
        sequence, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for b, own in enumerate(bins):
            at = 0
            for n in own:
                k = following[-n]
                following[-n] = k + 1
                sequence[k], offset[k] = b, at
                at += n
        return rows[["_row"]].assign(sequence_id=key[0] * (GROUP * 64) + sequence, offset=offset)
    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path or vocabulary(), capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Full pieces are sequences of their own; the others are packed by groups.
    """
    pieces = token_pieces(docs, path, capacity)
    pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.where(F.col("length") < capacity).count() // GROUP))
    short = (pieces.where(F.col("length") < capacity)
             .withColumn("group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
             .select("_row", "length", "group"))
    placed = short.groupBy("group").applyInPandas(_pack(capacity), "_row long, sequence_id long, offset long")
    full = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("long")})
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return (pieces.where(F.col("length") < capacity).join(placed, "_row").select(*columns)
            .unionByName(full.select(*columns)))
