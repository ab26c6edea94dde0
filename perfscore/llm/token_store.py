"""Token ids in files, compressed by Re-Pair grammars.

Documents are encoded in ascending order of doc_id, ended by an id, and laid end to
end in shards of about ``SHARD_IDS`` ids.  In each shard, frequent pairs of
neighbouring ids are replaced by new symbols (nonterminals) again and again, until no
pair occurs ``MIN_COUNT`` times; pairs of like frequency are replaced in one round.
A shard's file row holds the rules, each rule's expansion length, the symbols that are
left, and where each document starts, so that a document can be decoded alone: the
running sum of the expansion lengths tells which symbols cover it.

Files are Parquet tables with one binary block per shard, so they lie wherever Spark
writes and are committed whole, task by task.

Layout of a block, little-endian: the magic ``RPR1``; counts of base symbols, rules,
symbols and documents (uint32 each); rules (left and right, uint32 pairs); expansion
lengths (uint32); symbols as their low halves (uint16) and then their high bytes
(uint8); document starts within the shard, and their end (uint32).

Defined results for odd input: a null text is an empty one (the end id alone); rows
of one doc_id stand side by side in the order of their texts' hashes (different texts of a doc_id
may lie in different parts), repeated rows as often as they occur; null doc_ids come first; an empty table gives files without blocks;
other columns are not written.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfscore.llm.common import in_slices, ship_package
from perfscore.llm.tokens import END, crc32, encoder, vocabulary

MAGIC = b"RPR1"
SHARD_IDS = 1 << 18
#: A pair must occur so often in a shard to be worth a rule.  A rule takes 12 bytes and a replacement saves about 3;
#: rarer pairs hardly make blocks smaller but cost time (README has the figures).
MIN_COUNT = 12
#: A round replaces the pairs that occur at least 1 / LIKE as often as the most frequent one.
LIKE = 16
SLOTS = 16  # bits of the counting table that finds the pairs worth an exact count


def _frequent_pairs(seq: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (left << 32 | right, sorted) of about the greatest frequency, min_count at least;
    the places that may hold them, and what these hold."""
    pairs = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
    slot = (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)
    counted = np.bincount(slot, minlength=1 << SLOTS)  # a slot counts at least what its pairs do
    bar = max(min_count, int(counted.max()) // LIKE)
    while True:
        places = np.flatnonzero(counted[slot] >= bar)
        held = pairs[places]
        near = np.sort(held)
        first = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]])) if len(near) else np.empty(0, int)
        often = np.diff(np.concatenate([first, [len(near)]])) >= bar
        if often.any() or bar == min_count:
            return near[first[often]], places, held
        bar = max(min_count, bar // LIKE)


def re_pair(ids: np.ndarray, base: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Rules (rows of left, right; rule k is the symbol base + k) and the symbols left."""
    seq, rules = ids.astype(np.uint32), []
    known = 0
    while len(seq) > 1:
        chosen, places, held = _frequent_pairs(seq, min_count)
        if not len(chosen):
            break
        at = np.searchsorted(chosen, held)
        at[at == len(chosen)] = 0
        found = chosen[at] == held
        hit, at = places[found], at[found]
        # of hits that overlap, every other one is taken, from the left of each run
        new_run = np.concatenate([[True], np.diff(hit) > 1])
        start = hit[np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))]
        taken = (hit - start) % 2 == 0
        hit = hit[taken]
        seq[hit] = (base + known + at[taken]).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        seq = seq[keep]
        rules.append(np.stack([(chosen >> np.uint64(32)).astype(np.uint32), chosen.astype(np.uint32)], axis=1))
        known += len(chosen)
    return np.concatenate([*rules, np.empty((0, 2), np.uint32)]), seq


def _layers(rules: np.ndarray, base: int) -> Iterator[tuple[int, int]]:
    """Runs of rules that name only symbols known before the run."""
    newest, lo = rules.astype(np.int64).max(axis=1, initial=0) - base, 0
    while lo < len(rules):
        later = np.flatnonzero(newest[lo:] >= lo)
        hi = lo + int(later[0]) if len(later) else len(rules)
        yield lo, hi
        lo = hi


def pack_block(docs: list[np.ndarray], base: int, min_count: int = MIN_COUNT) -> bytes:
    """The block of a shard's documents."""
    ids = np.concatenate(docs)
    rules, seq = re_pair(ids, base, min_count)
    lengths = np.ones(base + len(rules), np.uint32)
    for lo, hi in _layers(rules, base):
        lengths[base + lo:base + hi] = lengths[rules[lo:hi]].sum(axis=1)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    return b"".join([MAGIC, struct.pack("<4I", base, len(rules), len(seq), len(docs)),
                     rules.astype("<u4").tobytes(), lengths[base:].astype("<u4").tobytes(),
                     seq.astype("<u2").tobytes(), (seq >> 16).astype("u1").tobytes(), starts.astype("<u4").tobytes()])


class Block:
    """A shard's block: all its documents, or one alone."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token block")
        self.base, rules, symbols, self.docs = struct.unpack_from("<4I", data, 4)
        at = 20

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self._rules = read("<u4", 2 * rules).reshape(-1, 2)
        self._lengths = read("<u4", rules)
        low, high = read("<u2", symbols), read("u1", symbols)
        self._seq = low.astype(np.int64) | high.astype(np.int64) << 16
        self.starts = read("<u4", self.docs + 1).astype(np.int64)
        self._symbol_len = np.concatenate([np.ones(self.base, np.int64), self._lengths.astype(np.int64)])
        self._flat: np.ndarray | None = None

    def _expansions(self) -> None:
        """Work out all symbols' ids end to end, and where each symbol's begin."""
        if self._flat is None:
            self._from = np.cumsum(self._symbol_len) - self._symbol_len
            self._flat = np.empty(int(self._symbol_len.sum()), np.uint32)
            self._flat[:self.base] = np.arange(self.base, dtype=np.uint32)
            for lo, hi in _layers(self._rules, self.base):
                ids = self._gather(self._rules[lo:hi].ravel())
                at = int(self._from[self.base + lo])
                self._flat[at:at + len(ids)] = ids

    def _gather(self, symbols: np.ndarray) -> np.ndarray:
        n = self._symbol_len[symbols]
        index = np.repeat(self._from[symbols] - (np.cumsum(n) - n), n)
        index += np.arange(len(index))
        return self._flat[index]

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        self._expansions()
        return self._gather(symbols)

    def all_ids(self) -> np.ndarray:
        """The shard's ids, end to end."""
        return self._expand(self._seq)

    def document(self, k: int) -> np.ndarray:
        """The ids of document k, from the symbols that cover it alone."""
        ends = np.cumsum(self._symbol_len[self._seq])
        lo, hi = self.starts[k], self.starts[k + 1]
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left")
        ids = self._expand(self._seq[first:last + 1])
        skip = lo - (ends[first - 1] if first else 0)
        return ids[skip:skip + hi - lo]


def _shards(path: str, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        end = np.array([END], np.uint32)
        part, number = TaskContext.get().partitionId(), 0
        docs: list[np.ndarray] = []
        names: list = []
        held = 0

        def block() -> pa.RecordBatch:
            data = pack_block(docs, tokens.size)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                ["part", "number", "n_ids", "doc_ids", "block"])

        for b in in_slices(batches, 2500):
            encoded = tokens.encode_column(b.column("text"))
            for name, ids in zip(b.column("doc_id").to_pylist(), encoded):
                docs.append(np.concatenate([ids, end]))
                names.append(name)
                held += len(docs[-1])
                if held >= shard_ids:
                    yield block()
                    docs, names, held, number = [], [], 0, number + 1
        if docs:
            yield block()
    return run


def write_tokens(docs: DataFrame, target: str, path: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write the shards' blocks under ``target``."""
    ship_package(docs.sparkSession)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"))
               .repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text"))
    ordered.select("doc_id", "text").mapInArrow(_shards(path or vocabulary(), shard_ids),
                       "part long, number long, n_ids long, doc_ids array<long>, block binary").write.parquet(target)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k, (names, data) in enumerate(zip(b.column("doc_ids"), b.column("block"))):
            block = Block(data.as_py())
            ids, at = block.all_ids(), block.starts
            crcs = [crc32(ids[a:z]) for a, z in zip(at[:-1], at[1:])]
            shard = [b.column(c).slice(k, 1).take(pa.array(np.zeros(block.docs, np.int64))) for c in ("part", "number")]
            yield pa.RecordBatch.from_arrays(
                [*shard, names.values, pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())],
                ["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, source: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    Blocks are decoded where they lie; only the documents' numbers meet the shards'
    offsets, which are summed over the write's parts first and then within each part.
    """
    ship_package(spark)
    shards = spark.read.parquet(source)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before_part.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (shards.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_part"))
               .join(parts, "part").select("part", "number", (F.col("part_start") + F.col("in_part")).alias("before")))
    docs = shards.select("part", "number", "doc_ids", "block").mapInArrow(
        _documents, "part long, number long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
