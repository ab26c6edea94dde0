"""Line dedup by a log-template tree of fixed depth.

Every line descends by its number of tokens and its leading tokens to a leaf; tokens
that hold a digit are variable fields (``<*>``) from the start, the others are words.  A word's
support is the number of the leaf's different lines that have it at the same place.  The fixed
words of a template all have about its number of lines as their support, and a field's
value has less, however many lines share it.  So a word is fixed if its support is at least
``support`` of the line's typical one (the upper median over the words after the leading ones)
and variable otherwise: field values may recur as often as they like.

A line is an instance of the template of its fixed words if these are ``min_words`` at least,
``similarity`` of its words and ``share`` of all its tokens.  Other lines stand for themselves: by their
masked text if words make up ``share`` of the tokens, so that a number may differ, else by
their exact tokens, so that rows of numbers are told apart.  A template recurs when it occurs in ``min_texts`` different texts; its
lines are dropped from all but the first text (the one with the smallest doc_id),
so nothing is lost altogether.  Documents of equal texts count as one text and keep
the same lines.

Only built-in expressions run.  Lines are counted by partial aggregates of narrow
keys; texts move twice (lines of leaves with several different lines, and the join
that takes out the dropped lines).

Defined results for odd input: null and empty texts have no lines to drop and stay
as they are; blank lines are kept and are never templates; repeated rows (equal
doc_id and text) lose the same lines; a null doc_id counts as the smallest; a tie
between texts of one doc_id goes to the smaller text hash; an empty table gives an
empty table; extra columns stay, and columns that clash with the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import boxed, let, materialize, unboxed, whole_text, with_struct

WILDCARD = "<*>"
#: Leaves are first looked up by their remainders; so many can be told apart.
SLOTS = 1 << 20


@dataclass(frozen=True)
class TemplateTree:
    """Leading tokens of a path, texts that make a template recur, and the shares in tenths (see above).

    The shares are those at which planted templates of 5 to 12 tokens with one or two fields are
    found for any number of values, while prose of the same beginnings and rows of
    numbers stay (``tests/llm/test_line_dedup.py``).
    """

    leading: int = 3
    min_texts: int = 2
    support: int = 7
    similarity: int = 7
    share: int = 6
    min_words: int = 4


def _tokens(line: Column) -> Column:
    """The words of a line of ``_lines``, whose only white space is the space (a regex would be compiled for each line)."""
    return F.array_remove(F.split(line, " "), "")


def _has_digit(text: Column) -> Column:
    return F.rlike(text, F.lit(r"\d"))


def masked_tokens(line: Column) -> Column:
    """Tokens of a line of ``_lines``, those with a digit as the wildcard."""
    masked = F.regexp_replace(line, r"(?<![^ ])[^ \d]*+\d[^ ]*+", WILDCARD)
    return _tokens(F.when(_has_digit(line), masked).otherwise(line))


def _lines(docs: DataFrame) -> DataFrame:
    """Lines of all texts: doc_id, text_key, line_no and line, with spaces for other white space.

    Texts are hashed before their lines are generated: after that it would be once a line.
    """
    text = whole_text("text")
    spaced = F.when(reduce(or_, [F.contains(text, F.lit(c)) for c in "\t\v\f\r"]),
                    F.regexp_replace(text, r"[\x09\x0B-\x0D]", " ")).otherwise(text)
    return (docs.select("doc_id", F.xxhash64(text).alias("text_key"), spaced.alias("text"))
            .select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line")))


def _with_tokens(lines: DataFrame, tokens: Column) -> DataFrame:
    """Lines with words, and their tokens, which are generated, not projected: they are made once a line."""
    return lines.select("*", F.explode(F.array(tokens)).alias("tokens")).where(F.size("tokens") > 0)


def _leaf(tree: TemplateTree, masked: bool) -> Column:
    """The leaf of a line's ``tokens``; of those that are not masked yet, only the leading ones are looked at."""
    leading = [F.get("tokens", F.lit(i)) for i in range(tree.leading)]
    if not masked:
        leading = [F.when(_has_digit(token), F.lit(WILDCARD)).otherwise(token) for token in leading]
    return F.xxhash64(F.size("tokens"), *leading)


def _line_key(tokens: Column) -> Column:
    """The key of a masked line (its leaf is another hash, of a different seed)."""
    return F.xxhash64(F.lit("line"), tokens)


def _keyed(docs: DataFrame, tree: TemplateTree) -> DataFrame:
    """Lines with words: doc_id, text_key, line_no, leaf, line_key and exact_key (lines mostly of numbers)."""
    line, tokens = F.col("line"), F.col("tokens")
    words = F.size(F.array_remove(tokens, WILDCARD))
    numbers = F.array_contains(tokens, WILDCARD) & (10 * words < tree.share * F.size(tokens))
    return _with_tokens(_lines(docs), masked_tokens(line)).select(
        "doc_id", "text_key", "line_no", _leaf(tree, masked=True).alias("leaf"), _line_key(tokens).alias("line_key"),
        F.when(numbers, F.xxhash64(F.lit("exact"), _tokens(line))).alias("exact_key"))


def _templates(docs: DataFrame, keyed: DataFrame, tree: TemplateTree) -> DataFrame:
    """leaf, line_key -> template, for lines that are an instance of one."""
    several = (keyed.groupBy("leaf").agg(F.min("line_key").alias("lo"), F.max("line_key").alias("hi"))
               .where("lo <> hi").select("leaf"))
    # lines of other leaves mostly go before they are masked and shuffled; the broadcast has at most SLOTS rows
    line, slot = F.col("line"), F.pmod("leaf", F.lit(SLOTS)).alias("slot")
    near = (_with_tokens(_lines(docs), _tokens(line)).select("line", _leaf(tree, masked=False).alias("leaf")).select("leaf", "line", slot)
            .join(F.broadcast(several.select(slot).distinct()), "slot", "left_semi")
            .select("leaf", _line_key(masked_tokens(line)).alias("line_key"), "line"))
    one = (near.join(several, "leaf", "left_semi")
           .dropDuplicates(["leaf", "line_key"]).withColumn("tokens", masked_tokens(line)))
    inside = (one.select("leaf", "line_key", F.size("tokens").alias("n"), F.posexplode("tokens").alias("place", "token"))
              .where(F.col("token") != WILDCARD)
              .withColumn("token", F.xxhash64("token")))
    inside = materialize(inside, "line-tokens")
    support = inside.groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("lines"))
    counted = (inside.join(support, ["leaf", "place", "token"])
               .select("leaf", "line_key", "n", F.xxhash64("place", "token").alias("word"), "lines",
                       (F.col("place") < tree.leading).alias("leads"))
               .repartition("leaf", "line_key")  # a line's words meet; there is no more to combine before
               .groupBy("leaf", "line_key", "n").agg(F.collect_list(F.struct("word", "lines", "leads")).alias("words")))
    # each step is generated, not projected: base and fixed words are worked out once a line
    after = F.array_sort(F.transform(F.filter("words", lambda w: ~w["leads"]), lambda w: w["lines"]))
    counted = with_struct(counted, let(after, lambda x: F.struct(F.get(x, F.floor(F.size(x) / 2).cast("int")).alias("base"))))
    fixed = F.filter("words", lambda w: (w["lines"] > 1) & (10 * w["lines"] >= tree.support * F.col("base")))
    counted = with_struct(counted, let(fixed, lambda x: F.struct(
        F.size(x).alias("n_fixed"),
        F.aggregate(x, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(w["word"])).alias("own"))))
    tenfold = 10 * F.col("n_fixed")
    found = (counted.where((F.col("n_fixed") >= tree.min_words) & (tenfold >= tree.similarity * F.size("words"))
                           & (tenfold >= tree.share * F.col("n")))
             .select("leaf", "line_key", F.xxhash64(F.lit("template"), "n_fixed", "own").alias("template")))
    return materialize(found, "line-templates")


def recurring_lines(docs: DataFrame, tree: TemplateTree | None = None) -> DataFrame:
    """doc_id, text_key and ``dropped`` (line numbers from 0) of documents that lose lines."""
    tree = tree or TemplateTree()
    keyed = materialize(_keyed(docs, tree), "line-keys")
    known = _templates(docs, keyed, tree)
    templated = (keyed.join(known, ["leaf", "line_key"], "left")
                 .withColumn("template", F.coalesce("template", "exact_key", "line_key")).drop("line_key", "exact_key"))
    texts = templated.groupBy("leaf", "template", "text_key").agg(
        F.min(F.coalesce("doc_id", F.lit(-1 << 63))).alias("first"))
    recurring = (texts.groupBy("leaf", "template")
                 .agg(F.count(F.lit(1)).alias("n_texts"),
                      F.min(F.struct("first", "text_key"))["text_key"].alias("home"))
                 .where(F.col("n_texts") >= tree.min_texts).drop("n_texts"))
    return (templated.join(recurring, ["leaf", "template"])
            .where("text_key <> home")
            .groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("dropped")))


def drop_recurring_lines(docs: DataFrame, tree: TemplateTree | None = None) -> DataFrame:
    """Add n_lines, n_dropped, dropped (sorted line numbers) and clean_text (the lines left)."""
    return unboxed(_marked(docs, tree), docs.columns, added=("n_lines", "n_dropped", "dropped", "clean_text"))


def _marked(docs: DataFrame, tree: TemplateTree | None) -> DataFrame:
    """Boxed rows with n_lines, n_dropped, dropped and clean_text."""
    gone = recurring_lines(docs, tree).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "dropped")
    keyed = boxed(docs, F.col("doc_id").alias("_own_id"), F.xxhash64(whole_text("text")).alias("_own_key"))
    joined = keyed.join(gone, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left")
    text = F.col("_all")["text"]  # the text moves once, within its row
    lines = F.split(whole_text(text), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "dropped")
    clean = F.when(F.col("dropped").isNull(), text).otherwise(
        let(lines, lambda x: F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n")))
    return joined.select(
        "_all", F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.sort_array("dropped"), F.array().cast("array<int>")).alias("dropped"),
        clean.alias("clean_text"))


def without_recurring_lines(docs: DataFrame, tree: TemplateTree | None = None) -> DataFrame:
    """The columns of ``docs`` with recurring lines taken out; documents that lose all their words go."""
    marked = _marked(docs, tree)
    changed, empty = F.col("n_dropped") > 0, ~F.rlike("clean_text", F.lit(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col("_all")["n_chars"]) \
        if "n_chars" in docs.columns else F.lit(None)
    return unboxed(marked.where(~(changed & empty)), docs.columns, {"text": F.col("clean_text"), "n_chars": n_chars})
