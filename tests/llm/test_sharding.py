import zlib

from pyspark.sql import functions as F

from perfscore.llm import sharding as s


def test_rows_sizes_and_gapless_slots(documents):
    rows = s.shard_documents(documents).collect()
    assert len(rows) == documents.count()
    text = {r.doc_id: r.text for r in documents.collect()}
    slots = {}
    for r in rows:
        body = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 1, zlib.crc32(body), "key") and 0 <= r.shard < 8
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and len(slots) == 8


def keys(spark, tree, n=40_000):
    return spark.range(n).select("id", s.shard_of(F.col("id"), tree).alias("s"))


def test_shares_follow_the_weights(spark):
    tree = [s.Leaf(0, 0, 0, 1.0), s.Leaf(0, 1, 1, 2.0), s.Leaf(1, 2, 2, 5.0)]
    got = {r.s: r["count"] for r in keys(spark, tree).groupBy("s").count().collect()}
    assert all(abs(got[x.shard] / 40_000 - x.weight / 8) < 0.01 for x in tree)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    old, new = keys(spark, s.even_tree()), keys(spark, s.with_new_shard(s.even_tree()))
    moved = old.join(new.withColumnRenamed("s", "t"), "id").where("s <> t").groupBy("t").count().collect()
    assert [r.t for r in moved] == [8] and abs(moved[0]["count"] / 40_000 - 1 / 9) < 0.01


def test_a_changed_weight_moves_keys_across_its_subtree_alone(spark):
    tree = s.even_tree()
    heavier = [s.Leaf(x.region, x.rack, x.shard, 3.0) if x.shard == 7 else x for x in tree]
    pairs = keys(spark, tree).join(keys(spark, heavier).withColumnRenamed("s", "t"), "id").where("s <> t").collect()
    assert pairs and all(r.t in (4, 5, 6, 7) for r in pairs)  # only into the region of shard 7
    assert all(r.t in (6, 7) for r in pairs if r.s in (4, 5))  # within it, only into its rack
    assert all(r.t == 7 for r in pairs if r.s == 6)


def test_hot_shards_are_numbered_in_parts(spark, documents, monkeypatch):
    from perfscore.llm import common

    rows = common.ranked(spark.range(1000).select(F.lit("one").alias("g"), "id"), ["g"], ["id"], F.col("id"), "r", 64)
    got = sorted(r.r for r in rows.collect())
    assert got == list(range(1000))


def test_odd_documents(odd, none):
    rows = s.shard_documents(odd).collect()
    assert len(rows) == odd.count() and s.shard_documents(none).count() == 0
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert all((r.size, r.text_crc32) == (1, 0) for r in empty)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
