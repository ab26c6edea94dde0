"""Exact dedup: rows grouped by a 128-bit content hash, bytes compared inside the groups.

Two texts are copies when they are identical after deleting all ASCII white space.  Of
a group the row with the most code points in the original text stays; ties go to the
smallest doc_id.

1. *Compare bytes.*  Rows are counted by (hash, normalised text).  The partial counts
   leave one text per task and group, so copies collapse before the shuffle.  A hash
   that belongs to more than one text has collided.
2. *Fingerprint.*  Each row becomes a narrow record of its hash, length, checksum and id,
   written once.  Rows of collided hashes (none, as a rule) also carry their text, which
   then is part of their group's key, so that a collision joins no different texts.
3. *Group.*  A partial aggregate finds each group's size and the row that stays.  Groups
   of one are final; the others' rows look their group up, those of hot groups in a
   bounded broadcast (``common.hot_join``).

Defined results for odd input: a null text is the empty one, and all texts of white
space alone are copies of it; a null doc_id comes after all others; of rows that tie in
length and doc_id (repeated rows) one stays, and the others are dropped with its doc_id
as their keep_id; an empty table gives an empty table; no other column is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import boxed, hot_join, materialize, numbered_table, unboxed, whole_text

#: ASCII white space: tab to carriage return, and space.
GAPS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.translate(text, GAPS, "")


def content_hash(norm: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(norm))


def collided_hashes(docs: DataFrame, text: str = "text",
                    hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The hashes that more than one normalised text has (``_h``)."""
    norm = docs.select(normalised(whole_text(text)).alias("_norm"))
    texts = norm.select(hashed(F.col("_norm")).alias("_h"), "_norm").groupBy("_h", "_norm").count()
    return texts.groupBy("_h").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("_h")


def find_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text)."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(f"`{text}`").alias("_text"))
    return _grouped(rows, hashed).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows that stay, with all their columns."""
    held = numbered_table(boxed(docs, F.col(f"`{doc_id}`").alias("doc_id"),
                                whole_text(f"`{text}`").alias("_text")), "exact-rows")
    stays = _grouped(held.select("doc_id", "_text", F.col("_row").alias("_given")), hashed).where("kept")
    return unboxed(held.join(stays.select(F.col("_given").alias("_row")), "_row", "left_semi"), docs.columns)


def _grouped(rows: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """``rows`` (doc_id, _text, others) as narrow records with their group's size and row that stays."""
    others = [c for c in rows.columns if c not in ("doc_id", "_text")]
    collided = materialize(collided_hashes(rows, "_text", hashed), "collided")
    marked = rows.withColumn("_norm", normalised(F.col("_text")))
    marked = marked.withColumn("_h", hashed(F.col("_norm")))
    marked = marked.join(collided.withColumn("_hit", F.lit(True)), "_h", "left")
    prints = numbered_table(marked.select(
        "doc_id", *others, "_h", F.when(F.col("_hit"), F.col("_norm")).alias("_same"),
        F.length("_text").alias("_chars"), F.xxhash64("_text").alias("_tie"),
        F.sha2(F.col("_norm"), 256).alias("text_sha256")), "fingerprints")

    best = F.min(F.struct((-F.col("_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                          "doc_id", "_tie", "_row"))
    groups = (prints.groupBy("_h", "_same").agg(F.count(F.lit(1)).alias("_n"), best.alias("_best"))
              .where("_n > 1").select("_h", "_same", "_n", F.col("_best.doc_id").alias("_keep"),
                                      F.col("_best._row").alias("_stays")))
    found = hot_join(prints, groups, ["_h", "_same"], "_n")
    alone = F.col("_n").isNull()
    return found.select(
        "doc_id", *others, "text_sha256",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_stays"))).alias("kept"))
