"""Line-first cleaning: rules per line, then documents that lose too much text go.

Each line of a document is held against punctuation, noise, shouting, navigation
and boilerplate rules.  Failing lines are removed; a document is rejected when a
base rule fails (too few words, too much repetition) or when the removed lines
hold more than ``max_lost`` of its characters.  Only built-in expressions run, and
nothing is shuffled: every rule reads one row.

Defined results for odd input: a null or empty text has no words, fails the base
rules and is not kept; blank lines fail no rule; repeated rows and ties are
judged each on its own; an empty table gives an empty table; extra input columns
stay as they are (columns that clash with a result's name are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import WORD_GAP, boxed, let, split_words, unboxed, whole_text, with_struct

#: Symbols that prose hardly holds; fixed by the contract of the base counts.
NOISE = r"[#*$%&|<>]"
#: Bits of a packed (window hash, position) that hold the position.
POS_BITS = 24
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class LineRules:
    """Parameters of the rules."""

    min_words: int = 50
    max_repeat_share: float = 0.5
    max_lost: float = 0.5
    max_symbols_per_word: float = 0.3
    max_upper_share: float = 0.6
    max_separators_per_word: float = 0.15
    boilerplate_chars: int = 160
    boilerplate: tuple[str, ...] = field(default=(
        "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service",
        "javascript", "sign up", "log in", "subscribe", "click here", "read more", "share this",
        "lorem ipsum"))
    #: A prose line ends a sentence somewhere: a mark, closing quotes or brackets, a gap or the end.
    sentence_end: str = r"[.!?…:;。！？][\"'”’»)\]]*(?:[\x20\x09-\x0D]|$)"


def _repeat_positions(words: Column, packed: Column) -> Column:
    """Starts of 3-word windows that occur twice or more, in ascending order.

    ``packed`` holds each window's hash (upper bits) and start (lower bits),
    sorted, so equal windows stand side by side.
    """
    def start(x):
        return x.bitwiseAND(F.lit((1 << POS_BITS) - 1))

    def key(x):
        return F.shiftright(x, POS_BITS)

    def equal(a, b):
        i, j = start(a).cast("int"), start(b).cast("int")
        return ((F.get(words, i) == F.get(words, j)) & (F.get(words, i + 1) == F.get(words, j + 1))
                & (F.get(words, i + 2) == F.get(words, j + 2)))

    def beside(x, k):
        before, after = F.get(packed, k - 1), F.get(packed, k + 1)
        return F.coalesce(key(before) == key(x), F.lit(False)) | F.coalesce(key(after) == key(x), F.lit(False))

    def unless_collision(hits):
        # a neighbour with the same hash but another window: go by the words themselves
        clash = F.exists(F.sequence(F.lit(1), F.size(hits) - 1),
                         lambda k: (key(F.get(hits, k)) == key(F.get(hits, k - 1)))
                         & ~equal(F.get(hits, k), F.get(hits, k - 1)))
        return (F.when(F.size(hits) < 2, F.transform(hits, start))
                .when(clash, _repeat_positions_exactly(words))
                .otherwise(F.transform(hits, start)))

    return F.sort_array(let(F.filter(packed, beside), unless_collision))


def _repeat_positions_exactly(words: Column) -> Column:
    """As ``_repeat_positions``, by sorting the windows' own words."""
    windows = F.array_sort(F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"),
                           i.cast("long").alias("p"))))

    def pick(ws):
        def beside(x, k):
            return (F.coalesce(F.get(ws, k - 1)["w"] == x["w"], F.lit(False))
                    | F.coalesce(F.get(ws, k + 1)["w"] == x["w"], F.lit(False)))
        return F.transform(F.filter(ws, beside), lambda x: x["p"])

    return let(windows, pick)


def _counts(text: Column, words: Column) -> list[Column]:
    """The base counts of a text and its words, as named fields (long)."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.rlike(s, F.lit(r"[^\x20\x09-\x0D]")))

    def window(i):
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def pack(h, i):
        return F.shiftleft(h, POS_BITS).bitwiseOR(i.cast("long"))

    none_found = F.array().cast("array<bigint>")
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)
    starts = (F.when(F.size(words) < 3, none_found)
              .when(F.size(words) >= (1 << POS_BITS), F.sort_array(_repeat_positions_exactly(words)))
              .otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none_found).otherwise(
                  let(F.sort_array(F.transform(h, pack)), lambda p: _repeat_positions(words, p))))))
    none = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        starts, none,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return [F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(NOISE)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words")]


def line_fails(line: Column, rules: LineRules) -> Column:
    """Whether a line breaks a rule; a line without words breaks none.

    The counting rules run only where a cheap test finds what they count.
    """
    def words():
        return F.length(line) - chars() + 1  # single gaps; more only lowers the shares

    def chars():
        return F.length(F.regexp_replace(line, WORD_GAP, ""))

    def count(pattern):
        return F.regexp_count(line, F.lit(pattern))

    def has(pattern):
        return F.rlike(line, F.lit(pattern))

    low = F.lower(line)
    boiler = F.lit(False)
    for phrase in rules.boilerplate:
        boiler = boiler | F.contains(low, F.lit(phrase))
    return ((~has(rules.sentence_end) & has(r"[^\x20\x09-\x0D]"))                        # no sentence end
            | (has(r"[#*$%&|<>»›•]") & ((count(NOISE) > rules.max_symbols_per_word * words())            # noise
                                        | (count("[|»›•]") > rules.max_separators_per_word * words())))  # navigation
            | (has(r"\p{Lu}{2}") & (count(r"\p{Lu}") > rules.max_upper_share * chars()))     # shouting
            | ((F.length(line) <= rules.boilerplate_chars) & boiler))                        # boilerplate


def clean_lines(docs: DataFrame, rules: LineRules | None = None, text: str = "text") -> DataFrame:
    """Add the base counts, base_failed, clean_text, n_lines, n_failed_lines, lost_chars and kept.

    ``clean_text`` is the text without its failing lines (in the order they had).
    """
    rules = rules or LineRules()
    body = whole_text(text)
    lines = F.split(body, "\n")

    def result(good, n):
        base_failed = ((n["n_words"] < rules.min_words)
                       | (n["n_repeat_words"] > rules.max_repeat_share * n["n_words"]))
        clean = F.array_join(good, "\n")
        lost = (n["word_chars"] - F.length(F.regexp_replace(clean, WORD_GAP, ""))).cast("long")
        return F.struct(*[n[c].alias(c) for c in BASE], base_failed.alias("base_failed"),
                        clean.alias("clean_text"), F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(good)).cast("long").alias("n_failed_lines"),
                        lost.alias("lost_chars"))

    counted = let(split_words(body), lambda words: F.struct(*_counts(body, words)))
    value = let(F.filter(lines, lambda s: ~line_fails(s, rules)),
                lambda good: let(counted, lambda n: result(good, n)))
    judged = with_struct(docs, value)
    return judged.withColumn("kept", ~F.col("base_failed")
                             & (F.col("lost_chars") <= rules.max_lost * F.col("word_chars")))


def keep_clean(docs: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """Documents that stay, with their failing lines removed; same columns as ``docs``."""
    kept = clean_lines(boxed(docs, "text"), rules).where("kept")
    return unboxed(kept, docs.columns, {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")})
