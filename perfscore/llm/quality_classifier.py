"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is binned.  Boosting goes round and round the features: at each
turn a shallow tree on one feature's bins is fitted to the gradient of the logistic
loss and added, shrunk, to that feature's lookup table.  Then the pairs of features
that would still lower the loss most get two-way tables in the same manner.  A score
is the sum of the table entries of a text's bins, looked up for whole batches at once.

Features are read from the whole text alone.  The model is fitted on a bounded sample
of labelled documents (at most ``max_rows`` rows, the smallest hashes of doc_id): a
doc_id counts once for each label that it has, with its smallest text; texts are scored
where they lie, without a shuffle.

Defined results for odd input: null and empty texts have all features 0 and are scored
like others; rows with a null label are no labels; without labels of both kinds every
score is the smoothed share of label 1; rows repeated in the labels or the documents
train once; repeated rows are scored each; a null doc_id
counts as in training (not held out); an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import in_slices, materialize, ship_package

FEATURES = ("log_words", "word_length", "symbols", "marks", "exclamations", "upper", "digits", "different_words",
            "repeated_words", "different_lines", "log_line_length", "bars", "sentence_ends")

#: Kinds of characters, as bits of a table over the first code points.
SYMBOL, MARK, EXCLAIM, UPPER, LETTER, DIGIT, BAR, SPACE = (1 << i for i in range(8))
_KINDS = np.zeros(1024, np.uint8)
for _i in range(1024):
    _c = chr(_i)
    _KINDS[_i] = (SYMBOL * (_c in "#*$%&<>@^~=+\\{}[]_/") | MARK * (_c in ".,;:?…") | EXCLAIM * (_c == "!")
                  | UPPER * _c.isupper() | LETTER * _c.isalpha() | DIGIT * _c.isdigit() | BAR * (_c == "|")
                  | SPACE * _c.isspace())


@dataclass(frozen=True)
class Training:
    """Parameters of the fit."""

    max_rows: int = 20_000
    bins: int = 32
    rounds: int = 60
    pairs: int = 6
    pair_rounds: int = 30
    rate: float = 0.2
    smoothing: float = 10.0


@dataclass
class AdditiveModel:
    """Cuts of each feature's bins, lookup tables of features and of pairs, and the base score."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row of features."""
        total = np.full(len(x), self.base)
        if self.cuts:
            b = self.bins(x)
            for j, table in enumerate(self.single):
                total += table[b[:, j]]
            for (j, k), table in self.pairs.items():
                total += table[b[:, j], b[:, k]]
        return 1 / (1 + np.exp(-total))


def text_features(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text."""
    texts = [t or "" for t in texts]
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    chars = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _KINDS[np.minimum(codes, 1023)] * (codes < 1024)
    full = np.flatnonzero(chars)
    starts = (np.cumsum(chars) - chars)[full]

    def count(bit: int) -> np.ndarray:
        c = np.zeros(n)
        if len(full):
            c[full] = np.add.reduceat((kinds & bit) != 0, starts, dtype=np.int64)
        return c

    words = np.zeros(n)
    for i, t in enumerate(texts):
        w, lines = t.split(), t.split("\n")
        words[i] = m = len(w)
        ends = t.count(". ") + t.count(".\n") + t.endswith(".")
        out[i, 7:] = (len(set(w)) / m if m else 0, sum(map(eq, w, w[1:])) / m if m else 0,
                      len(set(lines)) / len(lines), np.log1p(len(t) / len(lines)), 0, ends / m if m else 0)
    some, letters = np.maximum(words, 1), np.maximum(count(LETTER), 1)
    out[:, 0] = np.log1p(words)
    out[:, 1] = (chars - count(SPACE)) / some
    for j, bit in ((2, SYMBOL), (3, MARK), (4, EXCLAIM), (6, DIGIT), (11, BAR)):
        out[:, j] = count(bit) / some
    out[:, 5] = count(UPPER) / letters
    return out


def _split(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, int]:
    """The best cut of ordered bins by gradient and weight sums: gain, first bin of the right side."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - g.sum() ** 2 / (h.sum() + lam)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, lam: float) -> np.ndarray:
    """A tree of two levels on one feature's bins: the value of each bin."""
    out = np.empty(len(g))
    _, cut = _split(g, h, lam)
    for lo, hi in ((0, cut), (cut, len(g))):
        if lo < hi:
            _, inner = _split(g[lo:hi], h[lo:hi], lam)
            for a, z in ((lo, lo + inner), (lo + inner, hi)):
                if a < z:
                    out[a:z] = g[a:z].sum() / (h[a:z].sum() + lam)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, np.ndarray]:
    """A tree that cuts one feature of a pair and then, on either side, the other: gain, values."""
    best_gain, best = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        gain, cut = _split(a.sum(1), b.sum(1), lam)
        out = np.zeros_like(a)
        for lo, hi in ((0, cut), (cut, len(a))):
            if lo < hi:
                more, inner = _split(a[lo:hi].sum(0), b[lo:hi].sum(0), lam)
                gain += more
                for c, d in ((0, inner), (inner, a.shape[1])):
                    if c < d:
                        out[lo:hi, c:d] = a[lo:hi, c:d].sum() / (b[lo:hi, c:d].sum() + lam)
        if gain > best_gain:
            best_gain, best = gain, out.T if flip else out
    return best_gain, best


def fit_additive(x: np.ndarray, y: np.ndarray, spec: Training | None = None) -> AdditiveModel:
    """Cyclic boosting of the features' tables, then of the best pairs' tables."""
    spec = spec or Training()
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    quantiles = np.linspace(0, 1, spec.bins + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(c, quantiles)) for c in x.T]
    b = model.bins(x)
    sizes = [len(c) + 1 for c in model.cuts]
    model.single = [np.zeros(s) for s in sizes]
    total = np.full(len(y), model.base)

    def step() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(spec.rounds):
        for j, size in enumerate(sizes):
            g, h = step()
            values = spec.rate * _tree(np.bincount(b[:, j], g, size), np.bincount(b[:, j], h, size), spec.smoothing)
            model.single[j] += values
            total += values[b[:, j]]

    def sums(j: int, k: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(b[:, j] * sizes[k] + b[:, k], w, sizes[j] * sizes[k]).reshape(sizes[j], sizes[k])

    g, h = step()
    gains = {(j, k): _pair_tree(sums(j, k, g), sums(j, k, h), spec.smoothing)[0]
             for j, k in combinations(range(len(sizes)), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:spec.pairs]
    model.pairs = {(j, k): np.zeros((sizes[j], sizes[k])) for j, k in chosen}
    for _ in range(spec.pair_rounds):
        for j, k in chosen:
            g, h = step()
            values = spec.rate * _pair_tree(sums(j, k, g), sums(j, k, h), spec.smoothing)[1]
            model.pairs[j, k] += values
            total += values[b[:, j], b[:, k]]
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_slices(batches):
        x = text_features(b.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", spec: Training | None = None) -> AdditiveModel:
    """Fit on the labelled documents that are not held out, at most ``max_rows`` of them."""
    spec = spec or Training()
    ship_package(docs.sparkSession)
    sample = (labels.select("doc_id", F.col(label).cast("double").alias("label"))
              .where(F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & ~held_out())
              .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(spec.max_rows))
    sample = materialize(sample, "label-sample")  # bounded by max_rows, and so is what joins it
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min("text").alias("text")))
    rows = (texts.join(F.broadcast(sample), "doc_id").select("label", "text")
            .mapInArrow(_feature_rows, "label double, x array<double>").toPandas())
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    order = np.lexsort((*x.T, rows["label"].to_numpy(float)))  # the same sums in whatever order rows come
    return fit_additive(x[order], rows["label"].to_numpy(float)[order], spec)


def _score_rows(model: AdditiveModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            score = model.scores(text_features(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score)],
                                             ["doc_id", "held_out", "score"])
    return run


def score_quality(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    ship_package(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(
        _score_rows(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
