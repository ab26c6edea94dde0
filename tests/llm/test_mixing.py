from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perfscore.llm import mixing as m


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abc", max_size=3), st.integers(1, 60), min_size=1, max_size=9))
def test_no_source_is_a_block_off_at_any_slot(shares):
    slots = m.pfair_slots(shares)
    period = sum(shares.values())
    assert sorted(t for own in slots.values() for t in own) == list(range(period))
    for s, own in slots.items():
        for i, t in enumerate(own):  # block i + 1 within its window
            assert i * period // shares[s] <= t < -(-(i + 1) * period // shares[s])
        for t in range(period + 1):
            assert abs(sum(x < t for x in own) - Fraction(t * shares[s], period)) < 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 50), st.floats(1e-6, 1e6), min_size=1, max_size=30), st.integers(1, 500))
def test_shares_sum_up_to_the_period(weights, period):
    shares = m.shares_of(weights, period)
    assert sum(shares.values()) == max(period, len(weights)) and min(shares.values()) >= 1


@pytest.fixture
def docs(spark):
    return spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "hot").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string"))).alias("source"))


def test_the_mix_meets_its_targets_within_a_block_and_gives_every_row(docs):
    weights = {"hot": 2.0, "s0": 1.0, "s1": 1.0, "s2": 1.0}
    rows = sorted(m.mix_sources(docs, weights, block_docs=4, period=100).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(len(rows)))
    assert {r.doc_id for r in rows} == set(range(500))
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    given = dict.fromkeys(weights, 0)
    for r in rows:
        given[r.source] += 1
        assert r.slot == r.position // 4 and r.release <= r.slot < r.deadline
        for s, w in weights.items():
            assert abs(given[s] / 4 - (r.position + 1) / 4 * w / 5) < 2  # a block, and the one under way


def test_first_exhausted_gives_no_row_twice(docs):
    rows = m.mix_sources(docs, {"hot": 1, "s0": 1, "s1": 1, "s2": 1}, block_docs=4, stopping="first_exhausted").collect()
    assert rows and all(r.epoch == 0 for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    with pytest.raises(ValueError, match="no target weight"):
        m.mix_sources(docs, {"hot": 1})


def test_the_schedule_does_not_depend_on_the_partitioning(docs):
    one = {(r.doc_id, r.epoch): r.position for r in m.mix_sources(docs).collect()}
    assert one == {(r.doc_id, r.epoch): r.position for r in m.mix_sources(docs.repartition(5)).collect()}


def test_odd_documents(odd, none):
    rows = m.mix_sources(odd, block_docs=2).collect()
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in odd.collect()}
    mixed = m.mixed_documents(odd, block_docs=2)
    assert mixed.dtypes == odd.dtypes and mixed.count() == len(rows)
    assert m.mix_sources(none).count() == 0 == m.mixed_documents(none).count()


def off_by(sources, weights, steps):
    """How far any source is from its exact share at any slot, in blocks."""
    total, given = sum(map(Fraction, weights.values())), dict.fromkeys(sources, 0)
    worst = 0
    for t, (k, block, slot, release, deadline) in enumerate(steps):
        assert slot == t and block == given[sources[k]] and release <= slot < deadline
        given[sources[k]] += 1
        if t % 97 == 0:
            worst = max(worst, *(abs(given[s] - Fraction(weights[s]) * (t + 1) / total) for s in sources))
    worst = max(worst, *(abs(given[s] - Fraction(weights[s]) * sum(given.values()) / total) for s in sources))
    return worst, given


def test_a_tiny_source_is_given_at_its_exact_weight():
    rows = {f"big{i:02}": 20_000 for i in range(19)} | {"tiny": 10}
    weights = {s: 1.0 for s in rows} | {"tiny": 1e-4}
    names = sorted(rows)
    steps = list(m.mix_blocks([rows[s] for s in names], m.exact_shares(weights), 16, "all_exhausted"))
    worst, given = off_by(names, weights, steps)
    assert worst < 1 and given["tiny"] == 1 and given["big00"] >= 1250


def test_weights_count_with_more_than_a_thousand_sources(spark):
    rows = {f"s{i:04}": 3 for i in range(1100)} | {"hot": 1650}
    data = [(s, i) for s, n in rows.items() for i in range(n)]
    docs = spark.createDataFrame([(n, s) for n, (s, _) in enumerate(data)], "doc_id long, source string")
    weights = {s: float(n) for s, n in rows.items()}
    mix = m.mix_sources(docs, weights, block_docs=1).collect()
    names = sorted(rows)
    steps = [(names.index(r.source), r.block, r.slot, r.release, r.deadline) for r in sorted(mix, key=lambda r: r.slot)]
    worst, given = off_by(names, weights, steps)
    assert worst < 1 and {r.doc_id for r in mix} == set(range(len(data)))
    assert len(mix) < 1.001 * len(data)  # uniform shares would give every small source 1650 times


def test_weights_must_be_positive(docs):
    with pytest.raises(ValueError, match="must be positive"):
        m.mix_sources(docs, {"hot": 1, "s0": 0, "s1": 1, "s2": 1})
