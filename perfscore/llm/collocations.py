"""Phrase collocations by stripes: each prefix keys a counter of its next words.

A *stripe* belongs to a language and a prefix of 0 to 3 words and counts the words that
follow it.  Words that cannot make a candidate are left out, but in the stripe of the empty prefix
they are one cell without a word, so that its total is the number of all words.  Python counts the stripes of a slice of texts; the shuffle
merges stripes element by element: a stripe travels as its cells, which are summed
per (language, prefix, next word).  So the stripe of a very frequent prefix lies spread
over the tasks by its next words, and partial sums meet before the shuffle.

Everything is read off the merged stripes:

* extensions: a cell of at least ``min_count`` is a candidate, prefix and word;
* prefix totals: a prefix occurs as often as the cell of its last word says, in the stripe of its
  other words; so does every part that a cut leaves, 3 words at most;
* subsumption maxima: the greatest cell of a stripe is the most frequent
  extension of its prefix to the right, and the greatest cell per (first word taken off) that to the left.
  One word more is enough: a longer candidate's part of one word more than the phrase
  occurs at least as often, so it is a candidate too.

Which phrases can be candidates is found first, one length after the other.  A phrase of length k
can only reach ``min_count`` if both its parts of length k - 1 do, so only such occurrences are
counted, by ``KEY_BITS`` of their hash: a task sends its sorted hashes, as the steps between them, to
the task that merges their range; there are more ranges the more text there is.  Hashes that reach
``min_count`` travel on as a bit table of a fixed size (``BITS`` bits, whatever the input).  Phrases
that share a hash or a bit only make the tables admit too much: the stripes are counted by
their words, and exactly.

Defined results for odd input: a null text is empty, a null language ``und``; empty tables
and languages without candidates give no rows; repeated rows count as often as they occur; texts
of any length are counted whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfscore.llm.common import byte_slices, hot_join, materialize, ship_package, whole_text

#: Bits of the table of frequent phrases, a power of two (8 MB).
BITS = 1 << 26
#: Bytes of text that are counted together.
SLICE_BYTES = 2_000_000
#: What is kept of a hash to count by it; hashes that a task sorts together; bytes of text for each range of hashes.
KEY_BITS = 44
HELD = 4_000_000
RANGE_BYTES = 2_000_000
#: Parts that a language's candidates are ranked in before the last ranking.
PARTS = 64
CELLS = "size int, lang string, prefix string, word string, n long"

_WORD, _GAP, _STOP = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _STOP
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column's rows, end to end, and where each row ends."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    return data, offsets[1:] - offsets[0]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of an odd number and of its inverse


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to its end."""
    if len(_powers[0]) <= len(data):
        for k, factor in enumerate((int(_STEP), pow(int(_STEP), -1, 1 << 64))):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(data), factor, np.uint64)]))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][:len(data)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of a slice of texts, in order."""

    follows: np.ndarray    # whether the next word is in the same piece
    hashes: np.ndarray     # of language and word
    langs: pa.Array        # different languages
    lang: np.ndarray       # each word's, by place
    data: np.ndarray       # the texts' bytes, lower-case
    inside: np.ndarray     # which of them belong to words
    sizes: np.ndarray      # bytes of each word

    def spelled(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's place among the different words, and these."""
        offsets = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int32)
        body = np.ascontiguousarray(self.data[self.inside])
        words = pa.StringArray.from_buffers(len(self.sizes), pa.py_buffer(offsets), pa.py_buffer(body)).dictionary_encode()
        return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def words_of(texts: pa.Array, langs: pa.Array) -> Words:
    """Lower-case A-Z, cut texts into pieces and pieces into words."""
    data, ends = _buffers(texts)
    data = data | (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    kind = _KIND[data]
    inside = kind == _WORD
    begins = np.concatenate([[0], ends[:-1]])
    filled = ends > begins
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[begins[filled]] |= inside[begins[filled]]
    last[ends[filled] - 1] |= inside[ends[filled] - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(ends, start, "right")
    piece = np.cumsum(kind == _STOP, dtype=np.int32)[start]
    follows = np.zeros(len(start), bool)
    follows[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    own = langs.dictionary_encode()
    lang = own.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
    names, name_ends = _buffers(own.dictionary)
    lang_hashes = _hashes(names, np.concatenate([[0], name_ends[:-1]]), name_ends)
    hashes = _mixed(_hashes(data, start, stop) + _STEP * lang_hashes[lang])
    return Words(follows, hashes, own.dictionary, lang, data, inside, stop - start)


def _grams(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a phrase of that length begins at each word, and its hash."""
    total = len(words.hashes)
    whole, hashes = np.ones(total, bool), words.hashes
    for k in range(1, length):
        whole[:max(total - k, 0)] &= words.follows[k - 1:max(total - 1, k - 1)]
        whole[max(total - k, 0):] = False
        hashes = _mixed(hashes * _STEP + np.concatenate([words.hashes[k:], np.zeros(min(k, total), np.uint64)]))
    return whole, hashes


def _listed(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    slot = hashes & np.uint64(BITS - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _possible(words: Words, length: int, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of that length begin that both tables and parts admit, and all phrases' hashes.

    ``tables[k]`` lists the frequent phrases of k + 1 words, as far as they are known.
    """
    whole, hashes = _grams(words, length)
    if length <= len(tables):
        return whole & _listed(tables[length - 1], hashes), hashes
    if length == 1:
        return whole, hashes
    part, _ = _possible(words, length - 1, tables)
    return whole & part & np.concatenate([part[1:], np.zeros(min(1, len(part)), bool)]), hashes


def runs(keys: np.ndarray, range_bits: int, most: int) -> pa.RecordBatch:
    """Hashes with their counts (``most`` at most), one row per range of them.

    A range's hashes are sorted and told by the steps from one to the next, all lowest bytes
    first, then all second ones and so on, so that the empty ones lie together.
    """
    keys, n = np.unique(keys, return_counts=True)
    shift = np.uint64(KEY_BITS - range_bits)
    part = (keys >> shift).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[first] = keys[first] & ((np.uint64(1) << shift) - np.uint64(1))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)
    n = np.minimum(n, most).astype("<u4")
    width = -(-int(shift) // 8)
    ends = [*first[1:].tolist(), len(keys)]
    cuts = list(zip(first.tolist(), ends))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first]), pa.array([planes[a:z, :width].T.tobytes() for a, z in cuts], pa.binary()),
         pa.array([n[a:z].tobytes() for a, z in cuts], pa.binary())], ["part", "steps", "n"])


def frequent_keys(steps: list[bytes], counts: list[bytes], min_count: int) -> np.ndarray:
    """The hashes (within their range) of one range's runs that add up to ``min_count``."""
    keys, n = [], [np.frombuffer(c, "<u4") for c in counts]
    for run, own in zip(steps, n):
        planes = np.frombuffer(run, np.uint8).reshape(-1, len(own))
        wide = np.zeros((len(own), 8), np.uint8)
        wide[:, :len(planes)] = planes.T
        keys.append(np.cumsum(wide.view("<u8").ravel()))
    keys, n = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first[np.add.reduceat(n[order].astype(np.int64), first) >= min_count]]


def _bits_of(keys: np.ndarray) -> pa.Table:
    """The table's words that hold the keys' bits."""
    slot = np.unique(keys & np.uint64(BITS - 1))
    place, first = np.unique((slot >> np.uint64(6)).astype(np.int64), return_index=True)
    bits = np.uint64(1) << (slot & np.uint64(63))
    bits = np.bitwise_or.reduceat(bits, first) if len(first) else bits
    return pa.table({"place": place, "bits": bits.view(np.int64)})


def stripes(words: Words, max_words: int, tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The cells of the slice's stripes, for prefixes of 0 to ``max_words`` - 1 words.

    Next words that make no possible phrase are left out, or of no prefix, counted together.
    """
    word, dictionary = words.spelled()
    ids = words.lang  # a number for each (language, prefix)
    at = np.arange(len(word))  # where prefixes begin
    for length in range(1, max_words + 1):
        longer = np.zeros(len(word), bool)
        longer[_possible(words, length, tables)[0]] = True
        if length > 1:
            kept = longer[at]
            at, ids = at[kept], ids[kept]
        following = np.where(longer[at], word[at + length - 1], -1)
        code = ids * (len(dictionary) + 1) + following + 1
        _, cell, n = np.unique(code, return_index=True, return_counts=True)
        begin, ending = at[cell], following[cell]
        parts = [dictionary.take(pa.array(word[begin + k])) for k in range(length - 1)]
        prefix = pc.binary_join_element_wise(*parts, " ") if parts else pa.repeat("", len(begin))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(begin), length, np.int32)), words.langs.take(pa.array(words.lang[begin])).cast(pa.string()),
             prefix.cast(pa.string()), dictionary.take(pa.array(ending, mask=ending < 0)).cast(pa.string()),
             pa.array(n.astype(np.int64))], ["size", "lang", "prefix", "word", "n"])
        ids = np.unique(code, return_inverse=True)[1]


def _in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for b in batches:
        for lo, size in byte_slices(b.column("text"), SLICE_BYTES):
            yield words_of(b.column("text").slice(lo, size), b.column("lang").slice(lo, size))


def _read(tables: list) -> list[np.ndarray]:
    return [np.frombuffer(t.value, np.uint64) for t in tables]


def _frequent(rows: DataFrame, length: int, tables: list, min_count: int, range_bits: int) -> bytes:
    """The bits of the frequent phrases of one length: ``BITS`` / 8 bytes, however many there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _read(tables), []
        for words in _in_slices(batches):
            at, hashes = _possible(words, length, known)
            held.append(hashes[at] & np.uint64((1 << KEY_BITS) - 1))
            if sum(map(len, held)) >= HELD:
                yield runs(np.concatenate(held), range_bits, min_count)
                held = []
        if held:
            yield runs(np.concatenate(held), range_bits, min_count)

    def merge(own: pa.Table) -> pa.Table:
        keys = frequent_keys(own.column("steps").to_pylist(), own.column("n").to_pylist(), min_count)
        part = own.column("part")[0].as_py()
        return _bits_of(keys + (np.uint64(part) << np.uint64(KEY_BITS - range_bits)))

    sent = rows.mapInArrow(count, "part long, steps binary, n binary")
    found = (sent.groupBy("part").applyInArrow(merge, "place long, bits long")
             .groupBy("place").agg(F.bit_or("bits").alias("bits")))
    held = found.toArrow()  # at most BITS / 64 rows
    table = np.zeros(BITS // 64, np.int64)
    table[held.column("place").to_numpy()] = held.column("bits").to_numpy()
    return table.tobytes()


def phrase(prefix: str = "prefix", word: str = "word") -> Column:
    """Prefix and next word as one phrase."""
    return F.when(F.col(prefix) == "", F.col(word)).otherwise(F.concat(F.col(prefix), F.lit(" "), F.col(word)))


def count_stripes(docs: DataFrame, min_count: int = 30, max_words: int = 4, text: str = "text",
                  lang: str = "lang") -> DataFrame:
    """All merged stripes: size (words of prefix and next word), lang, prefix, word and n (``min_count`` at least).

    The words too rare for that are one cell without a word, of the empty prefix.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(whole_text(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"))
    size = rows.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    range_bits = min(20, max(1, (size // RANGE_BYTES).bit_length()))
    tables: list = []
    for length in range(1, max_words + 1):
        tables.append(spark.sparkContext.broadcast(_frequent(rows, length, tables, min_count, range_bits)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _read(tables)
        for words in _in_slices(batches):
            yield from stripes(words, max_words, known)

    keys = ["size", "lang", "prefix", "word"]
    merged = rows.mapInArrow(count, CELLS).groupBy(*keys).agg(F.sum("n").alias("n"))
    merged = merged.withColumn("word", F.when(F.col("n") >= min_count, F.col("word")))
    merged = merged.where((F.col("size") == 1) | F.col("word").isNotNull())
    return materialize(merged.groupBy(*keys).agg(F.sum("n").alias("n")), "stripes")


def _scores(candidates: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, size, a) with the lowest-scoring cut's l, r and score."""
    def halves(words: Column, size: Column) -> Column:
        cuts = F.sequence(F.lit(1), size - 1)
        return F.flatten(F.transform(cuts, lambda k: F.array(
            F.struct(k.alias("k"), F.lit(True).alias("is_left"), F.array_join(F.slice(words, 1, k), " ").alias("part")),
            F.struct(k.alias("k"), F.lit(False).alias("is_left"),
                     F.array_join(F.slice(words, k + 1, size - k), " ").alias("part")))))

    asked = candidates.select("lang", "phrase", "a", F.inline(halves(F.split("phrase", " "), F.col("size"))))
    uses = asked.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("_uses"))
    side = uses.join(totals, ["lang", "part"])
    found = hot_join(asked, side, ["lang", "part"], "_uses")
    cut = found.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("is_left"), F.col("total"))).alias("l"),
        F.max(F.when(~F.col("is_left"), F.col("total"))).alias("r"))
    score = F.expr("cast((cast(a as decimal(20, 0)) * 2000000BD) div (cast(l as decimal(20, 0)) + r) as long)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cut.groupBy("lang", "phrase", "a").agg(lowest.alias("_cut")).select(
        "lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def mine_collocations(docs: DataFrame, min_count: int = 30, max_words: int = 4, top: int = 2000,
                      subsumed: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n and score.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts that its lowest-scoring cut leaves, ``n``
    the language's words and ``score`` floor(2000000 * a / (l + r)).  A phrase goes if a
    candidate of one word more holds it and occurs at least ``subsumed`` in 100 times as often.
    """
    cells = count_stripes(docs, min_count, max_words, text, lang)
    words = materialize(cells.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n")), "languages")
    found = cells.where(F.col("word").isNotNull()).select("lang", "size", "prefix", phrase().alias("phrase"), F.col("n").alias("a"))
    found = materialize(found, "phrases")
    after = found.where("size > 2").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("a").alias("most_after"))
    totals = found.where(F.col("size") < max_words).select("lang", F.col("phrase").alias("part"), F.col("a").alias("total"))
    inner = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    before = found.where("size > 2").groupBy("lang", inner.alias("phrase")).agg(F.max("a").alias("most_before"))
    longer = found.where("size > 1").join(before, ["lang", "phrase"], "left").join(after, ["lang", "phrase"], "left")
    most = F.greatest(F.coalesce("most_before", F.lit(0)), F.coalesce("most_after", F.lit(0))).cast("decimal(20, 0)")
    own = longer.where(100 * most < subsumed * F.col("a").cast("decimal(20, 0)"))
    own = materialize(own.select("lang", "phrase", "size", "a"), "own")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = _scores(own, totals)
    scored = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = scored.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    best = best.where(F.col("_place") <= top)  # PARTS * top rows of a language at most go on
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
