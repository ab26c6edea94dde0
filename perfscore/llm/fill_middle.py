"""Fill-in-the-middle: texts cut at two of their token boundaries and laid out anew.

A text's tokens are its words with the white space before them, and the white space that
ends it.  The document's id decides the cuts, whether it is transformed, and the form:
``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>``
middle, ``plain`` the text as it is.  Texts that hold a marker stay plain, so the
pieces between the markers are always the pieces that were put there, and ``restored``
rebuilds the text from output and form alone.

Python finds the cuts: all token ends of a slice of texts go into one learned
index (``rank_index``), which maps a rank to its offset; a cut after k tokens of a text is
the rank of the text's start plus k.  Texts themselves stay in the JVM, which is told
the lengths of prefix and middle.

Defined results for odd input: a null text is the empty one and plain, with no tokens; a
null id draws as the empty string; repeated rows are transformed alike; an empty table
gives an empty table; other columns are kept, those named like an output give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import boxed, byte_slices, let, ship_package, unboxed, whole_text
from perfscore.llm.rank_index import RankIndex

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, SPM, PSM = "plain", "spm", "psm"
#: Bytes of text that share one index.
SLICE_BYTES = 8_000_000
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output")
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def token_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each token of texts ends, which lie end to end in ``data`` and end at ``ends``."""
    last = ~_GAP[data]
    last[:-1] &= _GAP[data[1:]]  # a word's last byte ...
    final = ends[np.diff(ends, prepend=0) > 0] - 1
    last[final] = True  # ... or a text's, be it a word's or a space's
    return np.flatnonzero(last) + 1


def cut_texts(texts: pa.Array, draws: list[np.ndarray], error: int = 120) -> tuple[np.ndarray, ...]:
    """Number of tokens of each text, and code points before its first and between its two cuts.

    A draw modulo (tokens + 1) is the number of tokens before a cut.
    """
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    ends = offsets[1:] - offsets[0]
    boundaries = np.concatenate([[0], token_ends(data, ends)])
    tokens_before = np.searchsorted(boundaries, ends, "right") - 1  # up to and with each text
    n = np.diff(tokens_before, prepend=0)
    index = RankIndex(boundaries, error)
    first, second = (tokens_before - n + d % (n + 1) for d in draws)
    cuts = [index.offset(np.minimum(first, second)), index.offset(np.maximum(first, second))]
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    begin, one, two = (chars[x] for x in (ends - np.diff(ends, prepend=0), *cuts))
    return n, one - begin, two - one


def _cutter(error: int):
    """The Arrow function (text, two draws) -> tokens, prefix and middle lengths."""
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, h1, h2 in batches:
            parts = [[], [], []]
            for lo, size in byte_slices(text, SLICE_BYTES):
                draws = [h.slice(lo, size).to_numpy(zero_copy_only=False) for h in (h1, h2)]
                for held, got in zip(parts, cut_texts(text.slice(lo, size), draws, error)):
                    held.append(got)
            whole = [np.concatenate([*p, np.empty(0, np.int64)]).astype(np.int64) for p in parts]
            yield pa.StructArray.from_arrays([pa.array(p) for p in whole], ["n", "prefix_chars", "middle_chars"])

    return F.arrow_udf(cut, "n long, prefix_chars long, middle_chars long", F.ArrowUDFType.SCALAR_ITER)


def draw(number: int, doc_id: Column, seed: str = "42") -> Column:
    """The ``number``-th (from 1) 32 bits of the hash of seed and id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(hashed, 8 * number - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: str = "42",
                   rate: int = 50, spm_rate: int = 80, error: int = 120) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output (the text as laid out).

    ``rate`` in 100 texts are transformed, of these ``spm_rate`` in 100 suffix first.
    """
    ship_package(docs.sparkSession)
    rows = boxed(docs, whole_text(f"`{text}`").alias("_text"),
                 *[draw(k, F.col(f"`{doc_id}`"), seed).alias(f"_h{k}") for k in (1, 2, 3, 4)])
    rows = rows.withColumn("_cut", _cutter(error)("_text", "_h1", "_h2"))
    body = F.col("_text")
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(body, F.lit(marker))
    plain = (body == "") | (F.col("_h3") % 100 >= rate) | marked
    rows = rows.withColumn("form", F.when(plain, PLAIN).when(F.col("_h4") % 100 < spm_rate, SPM).otherwise(PSM))
    moved = F.col("form") != PLAIN
    rows = rows.select("_all", "_text", "form", F.col("_cut.n").alias("n"),
                       F.when(moved, F.col("_cut.prefix_chars")).alias("prefix_chars"),
                       F.when(moved, F.col("_cut.middle_chars")).alias("middle_chars"))
    return unboxed(rows.withColumn("output", laid_out()), docs.columns, added=OUTPUTS)


def laid_out() -> Column:
    """The output of ``_text``, ``form`` and the lengths of prefix and middle."""
    body, one, two = F.col("_text"), F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.substring(body, F.lit(1), one), F.substring(body, one + 1, two)
    suffix = F.substring(body, one + two + 1, F.length(body))
    return (F.when(F.col("form") == SPM, F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
            .when(F.col("form") == PSM, F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
            .otherwise(body))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made from."""
    def joined(order: tuple[int, int, int]) -> Column:
        return let(F.split(output, "<[PSM]>", -1), lambda p: F.concat(*[F.get(p, F.lit(k)) for k in order]))

    return (F.when(form == SPM, joined((2, 3, 1))).when(form == PSM, joined((1, 3, 2))).otherwise(output))
