"""N-gram Jaccard join by MinHash banding.

Documents are sets of word n-grams (5 words; 64-bit hashes of the words).  Equal sets
form a class, of which one document stands for all.  Band and row counts are chosen
so that a pair at the threshold shares a band with probability ``recall``; classes
are shuffled on band hashes, and classes that share a band are connected to the
bucket's smallest class (no pairs within a bucket).  Each connected set of candidates
is then verified in blocks on the full n-gram sets: all pairs of a block are counted
by one matrix product, and a block returns one row per document (its links and the
root it is linked to), never its pairs.  Groups beyond a block are dealt as pairs of
blocks over many tasks.  Every pair of a candidate set is verified, so more links are
found than the bands alone would give.

Defined results for odd input: null and empty texts hold no n-gram and are linked to
nothing (each its own class); texts of one to four words are a single n-gram of all
their words; repeated rows and copies are in one class and linked to each other; null
doc_ids are documents like others (a class of only such has a null class_id); an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import boxed, in_slices, materialize, ship_package, split_words, unboxed, whole_text
from perfscore.llm.components import connected_components

#: Rows that a band holds; bands follow from the recall.
ROWS = 6
#: Classes of one block, and candidate classes of one task.
BLOCK = 512
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Bands:
    """Banding for a threshold: the number of bands of ROWS rows that reaches the recall."""

    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    rows: int = ROWS
    seed: int = 1

    @property
    def bands(self) -> int:
        hit = self.threshold ** self.rows
        return math.ceil(math.log(1 - self.recall) / math.log(1 - hit))


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words, in order."""
    return F.transform(split_words(text), lambda w: F.xxhash64(w))


def _scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted different n-gram hashes of a document's word hashes."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    w = words.astype(np.int64).view(np.uint64)
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = _scramble((h + w[k:len(w) - size + 1 + k]) * MIX)
    return np.unique(h)


def _signatures(spec: Bands):
    """Per batch: set hashes, set size and band hashes of each document, by its row's other columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(spec.seed)
        factors = rng.integers(1, 2 ** 63, spec.bands * spec.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for b in in_slices(batches):
            sets = [ngram_set(w, spec.words) for w in _word_arrays(b.column("words"))]
            sizes = np.array([len(s) for s in sets], np.int64)
            n = len(sets)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            filled = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[filled]
            c1, c2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            bands = np.zeros((n, spec.bands), np.uint64)
            if len(filled):
                c1[filled] = np.add.reduceat(_scramble(flat), starts)
                c2[filled] = np.add.reduceat(_scramble(flat ^ MIX), starts)
                for band in range(spec.bands):
                    key = np.full(len(filled), band, np.uint64)
                    for row in range(spec.rows):
                        low = np.minimum.reduceat(flat * factors[band * spec.rows + row], starts)
                        key = _scramble((key + low) * MIX)
                    bands[filled, band] = key
            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * spec.bands, bands.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("t1"), b.column("t2"), pa.array(sizes), pa.array(c1.view(np.int64)),
                 pa.array(c2.view(np.int64)), lists], ["doc_id", "t1", "t2", "n", "c1", "c2", "bands"])
    return run


def _word_arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a list column, without copies."""
    at = column.offsets.to_numpy()  # a slice keeps its whole batch's values
    values = column.values.to_numpy()
    return [values[a:z] for a, z in zip(at[:-1], at[1:])]


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each index of a symmetric link matrix is connected to."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each pair of sets has in common."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1  # n-grams of one set alone are in no pair
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    step = 8192
    for lo in range(0, int(shared.sum()), step):
        a, z = np.searchsorted(column, [lo, lo + step])
        part = np.zeros((len(sets), step), np.float32)
        part[owner[a:z], column[a:z] - lo] = 1
        out += part @ part.T
    return out


def _verify(threshold: float):
    """Per task: links and roots of the classes of each block or pair of blocks."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, left, right), g in rows.groupby(["component", "left", "right"], sort=True):
            g = g.sort_values("class").reset_index(drop=True)
            sets = [np.asarray(x).view(np.uint64) for x in g["grams"]]
            sizes = np.array([len(s) for s in sets], np.float64)
            common = _common(sets)
            union = sizes[:, None] + sizes[None, :] - common
            linked = common >= threshold * union - 1e-9
            if left == right:
                np.fill_diagonal(linked, False)
            else:  # pairs within a block are verified with that block alone
                linked &= g["block"].to_numpy()[:, None] != g["block"].to_numpy()[None, :]
            weight = g["members"].to_numpy(np.int64)
            out.append(pd.DataFrame({"class": g["class"], "links": linked.astype(np.int64) @ weight,
                                     "root": g["class"].to_numpy()[_roots(linked)]}))
        return pd.concat(out, ignore_index=True)
    return run


def near_classes(docs: DataFrame, spec: Bands | None = None) -> DataFrame:
    """Per document: doc_id, t1, t2 (its text's hashes), class_id, n_links.

    ``class_id`` is the smallest doc_id connected by links of at least the threshold;
    ``n_links`` counts the other documents whose n-gram sets reach the threshold with
    this one's, copies included.
    """
    spec = spec or Bands()
    ship_package(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text("text")).alias("t1"),
                        F.xxhash64(F.lit("t2"), whole_text("text")).alias("t2"), whole_text("text").alias("text"))
    signed = keyed.select("doc_id", "t1", "t2", word_hashes(F.col("text")).alias("words")).mapInArrow(
        _signatures(spec), "doc_id long, t1 long, t2 long, n long, c1 long, c2 long, bands array<long>")
    signed = materialize(signed.withColumn("_row", F.monotonically_increasing_id()), "signatures")

    # classes of equal sets; the class is named by its smallest row number
    classes = signed.where("n > 0").groupBy("c1", "c2").agg(
        F.min("_row").alias("class"), F.count(F.lit(1)).alias("members"))
    named = (signed.join(classes, ["c1", "c2"], "left")
             .select("_row", "doc_id", "t1", "t2", "n", "bands", F.coalesce("class", "_row").alias("class"),
                     F.coalesce("members", F.lit(1).cast("long")).alias("members")))
    named = materialize(named, "classes")
    stands = named.where("_row = class and n > 0")

    # candidates: classes that share a band, each joined to the smallest class of the bucket
    banded = stands.select("class", F.posexplode("bands").alias("band", "bucket"))
    buckets = (banded.groupBy("band", "bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
               .where("low < high").drop("high"))
    stars = banded.join(buckets, ["band", "bucket"]).where("class > low").select(
        F.col("class").alias("a"), F.col("low").alias("b")).distinct()
    components = materialize(connected_components(stars), "candidates")

    # deal candidates as blocks: small components share tasks, large ones are pairs of blocks
    total = components.count()
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    tasks = max(1, -(-total // BLOCK))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (components.join(sizes, "component")
             .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select(F.col("node").alias("class"), "component", "block",
                     F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
                     F.when(blocks == 1, F.pmod(F.xxhash64("component"), F.lit(tasks)))
                     .otherwise(F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")))
                     .alias("task")))
    wanted = dealt.join(stands.select("class", "members"), "class")
    # the texts of the classes' own documents: a key that differs from document to document
    own = (components.select(F.col("node").alias("class")).join(stands, "class")
           .select("class", F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2")))
    sets = (keyed.join(own, keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["t1"] == F.col("_t1"))
                       & (keyed["t2"] == F.col("_t2")))
            .select("class", word_hashes(F.col("text")).alias("words"))
            .mapInPandas(_gram_sets(spec.words), "class long, grams array<long>")
            .dropDuplicates(["class"]))
    sets = materialize(sets, "gram-sets")
    verified = (wanted.join(sets, "class")
                .select("task", "component", "left", "right", "block", "class", "members", "grams")
                .groupBy("task").applyInPandas(_verify(spec.threshold), "class long, links long, root long"))
    verified = materialize(verified, "links")

    groups = connected_components(verified.select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("class").agg(F.sum("links").alias("links"))
    result = (named.join(groups.withColumnRenamed("node", "class"), "class", "left")
              .join(links, "class", "left")
              .select("doc_id", "t1", "t2", F.coalesce("component", "class").alias("group"),
                      (F.coalesce("links", F.lit(0)) + F.col("members") - 1).cast("long").alias("n_links")))
    result = materialize(result, "grouped")
    first = result.groupBy("group").agg(F.min("doc_id").alias("class_id"))
    return result.join(first, "group").select("doc_id", "t1", "t2", "class_id", "n_links", "group")


def _gram_sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"class": b["class"],
                                "grams": [ngram_set(w, words).view(np.int64) for w in b["words"]]})
    return run


def one_of_each(docs: DataFrame, spec: Bands | None = None) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the smallest doc_id stays.

    A null doc_id counts as the largest; of repeated rows one stays.  Documents
    without n-grams (null and empty texts) all stay.
    """
    copies = (near_classes(docs, spec).withColumn("_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
              .groupBy("group", "_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n")))
    best = copies.groupBy("group").agg(F.min(F.struct("_id", "t1", "t2", "n")).alias("k"))
    stays = materialize(best.select(
        F.when(F.col("k._id") == (1 << 63) - 1, F.lit(None)).otherwise(F.col("k._id")).alias("k_id"),
        F.col("k.t1").alias("k1"), F.col("k.t2").alias("k2"), (F.col("k.n") > 1).alias("again")).distinct(), "stays")
    text = whole_text("text")
    keyed = boxed(docs, "doc_id", "text").select("_all", "doc_id", F.xxhash64(text).alias("_t1"),
                                                 F.xxhash64(F.lit("t2"), text).alias("_t2"))

    def of(keys: DataFrame) -> DataFrame:
        return keyed.join(keys, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("_t1") == F.col("k1"))
                          & (F.col("_t2") == F.col("k2")), "left_semi")

    # rows that stand there more than once meet as one row per task; texts without words are each their own group
    first = of(stays.where("not again")).unionByName(
        of(stays.where("again")).dropDuplicates(["doc_id", "_t1", "_t2"]))
    return unboxed(first, docs.columns)
