"""Hierarchical weighted hash tree: documents descend region, rack and shard by weighted draws.

At each level every child draws ``ln(u) / weight`` from the document's key, and the
largest draw wins, so a child gets its weight's share of the keys.  A child's draw
depends on the key, the child and its weight alone: raising a weight only draws keys
into that subtree, lowering it only sends keys out of it, and all other keys stay.
``with_new_shard`` adds a shard as a region of its own, so keys move into it only.

Defined results for odd input: null keys all draw alike (one shard); null texts have
size 1 and checksum 0; repeated rows get slots of their own; an empty table gives an
empty table; other input columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfscore.llm.common import let, numbered_table, ranked, whole_text


@dataclass(frozen=True)
class Leaf:
    """A shard's place in the tree and its weight; an inner node weighs what its shards weigh."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int = 8, shards_a_rack: int = 2, racks_a_region: int = 2) -> list[Leaf]:
    """Equal shards, filled rack by rack and region by region."""
    return [Leaf(s // (shards_a_rack * racks_a_region), s // shards_a_rack, s) for s in range(shards)]


def with_new_shard(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree and one more shard, in a region and a rack of its own."""
    return [*tree, Leaf(max(x.region for x in tree) + 1, max(x.rack for x in tree) + 1,
                        max(x.shard for x in tree) + 1, weight)]


def shard_of(key: Column, tree: list[Leaf], seed: int = 0) -> Column:
    """The shard that a key descends to."""
    return _descend(key, tree, ["region", "rack", "shard"], seed)


def _descend(key: Column, leaves: list[Leaf], levels: list[str], seed: int) -> Column:
    level, below = levels[0], levels[1:]
    children: dict[int, list[Leaf]] = {}
    for leaf in leaves:
        children.setdefault(getattr(leaf, level), []).append(leaf)
    best = _draw(key, level, {c: sum(x.weight for x in own) for c, own in children.items()}, seed)
    if not below:
        return best

    def go(child):
        out = F.lit(None).cast("int")
        for c, own in children.items():
            out = F.when(child == c, _descend(key, own, below, seed)).otherwise(out)
        return out

    return let(best, go)


def _draw(key: Column, level: str, weights: dict[int, float], seed: int) -> Column:
    """The child with the largest ln(u) / weight; u is uniform in (0, 1) by the key and the child."""
    if len(weights) == 1:
        return F.lit(next(iter(weights))).cast("int")
    draws = []
    for child, weight in sorted(weights.items()):
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}/{level}/{child}"), key), 11)
        draws.append(F.struct((F.log((bits + 0.5) / float(1 << 53)) / weight).alias("draw"),
                              F.lit(child).cast("int").alias("child")))
    return F.array_max(F.array(*draws))["child"]


def shard_documents(docs: DataFrame, tree: list[Leaf] | None = None, seed: int = 0) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot and grown_shard (with one more shard).

    Slots count from 0 without a gap within each shard, in the order of salted parts
    (see ``ranked``), so that no shard is numbered by a single task.
    """
    tree = tree or even_tree()
    body = F.encode(whole_text("text"), "UTF-8")
    placed = docs.select(
        "doc_id",
        (F.octet_length(whole_text("text")) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree, seed).alias("shard"),
        shard_of(F.col("doc_id"), with_new_shard(tree), seed).alias("grown_shard"))
    out = ranked(numbered_table(placed, "shards"), ["shard"], ["doc_id", "_row"], F.col("_row"), "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
