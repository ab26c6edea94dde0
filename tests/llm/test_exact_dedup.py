import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from perfscore.llm import exact_dedup as e


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha) of each row, as the contract states them."""
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or "", place))
    out = []
    for norm, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for doc_id, _, place in own:
            out.append((doc_id, best[0], len(own), hashlib.sha256(norm.encode()).hexdigest()))
    return out


def result(df):
    return [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=str)


def check(spark, docs, **how):
    got = e.find_copies(docs, **how).cache()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ordered(result(got)) == ordered(brute(rows))
    kept = got.where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in got.collect()})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_documents_against_brute_force(spark, documents):
    check(spark, documents)


def test_collisions_are_told_apart_by_their_bytes(spark, documents):
    weak = lambda norm: F.length(norm) % 7
    assert e.collided_hashes(documents, hashed=weak).count() == 7
    check(spark, documents, hashed=weak)


def test_longest_text_stays_then_the_smallest_id(spark):
    rows = [(4, "a b"), (2, "ab"), (3, "a  b"), (9, "a\t\tb"), (5, "ab ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.keep_id, r.group_size) for r in e.find_copies(docs).collect()} == {(3, 5)}
    assert [r.text for r in e.drop_copies(docs).collect()] == ["a  b"]


def test_other_white_space_is_content(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "a\x1cb")], "doc_id long, text string")
    assert e.find_copies(docs).where("kept").count() == 3


def test_a_hot_group_is_looked_up_in_a_broadcast(spark, monkeypatch):
    from perfscore.llm import common

    monkeypatch.setattr(common, "HOT_SHARE", 10)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(
        F.concat(F.lit("text "), (F.col("id") / 2).cast("int").cast("string"))).alias("text"))
    check(spark, docs)


def test_odd_documents(spark, odd, none):
    check(spark, odd)
    assert e.find_copies(none).count() == 0 and e.drop_copies(none).count() == 0
    left = e.drop_copies(odd)
    assert left.columns == odd.columns and left.count() == e.find_copies(odd).where("kept").count()
    assert {r.doc_id for r in left.collect() if not (r.text or "").strip()} == {3}
