import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perfscore.llm import fill_middle as m
from perfscore.llm.rank_index import RankIndex

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rate=50, spm_rate=80):
    """n, form, prefix and middle lengths, output, as the contract states them."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    parts = ["".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:])]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(tokens), "plain", None, None, text
    prefix, middle, suffix = parts
    if h[3] % 100 < spm_rate:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(docs, **how):
    made = m.fill_in_middle(docs, **how).withColumn("back", m.restored(F.col("output"), F.col("form")))
    rows = made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")
    return rows


def test_documents_against_brute_force(documents):
    rows = check(documents)
    assert len(rows) == documents.count() and {r.form for r in rows} == {"plain", "spm", "psm"}


def test_every_error_bound_gives_exact_cuts(documents):
    check(documents, error=1)
    check(documents, error=100_000)


def test_odd_documents(odd, none):
    assert len(check(odd)) == odd.count()
    made = m.fill_in_middle(odd)
    assert set(odd.columns) <= set(made.columns) and len(set(made.columns)) == len(made.columns)
    assert m.fill_in_middle(none).count() == 0


def test_texts_with_markers_stay_plain(spark):
    docs = spark.createDataFrame([(k, f"one two {x} three four") for k, x in enumerate(["<P>", "<S>", "<M>"] * 20)],
                                 "doc_id long, text string")
    assert {r.form for r in check(docs)} == {"plain"}


def test_pieces_that_end_like_a_marker_are_rebuilt(spark):
    docs = spark.createDataFrame([(k, "a <P b< S> <M P>> <S <") for k in range(200)], "doc_id long, text string")
    assert len({(r.form, r.prefix_chars) for r in check(docs)}) > 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é漢\t\n \x0b\x1c", max_size=12), min_size=1, max_size=8), st.integers(0, 2**32 - 1))
def test_cuts_of_any_texts(texts, seed):
    draws = [np.random.default_rng(seed + k).integers(0, 2**32, len(texts)) for k in (0, 1)]
    got = m.cut_texts(pa.array(["skipped", *texts]).slice(1), draws, error=1)
    for k, text in enumerate(texts):
        tokens = TOKEN.findall(text)
        a, b = sorted(int(d[k]) % (len(tokens) + 1) for d in draws)
        assert [int(x[k]) for x in got] == [len(tokens), len("".join(tokens[:a])), len("".join(tokens[a:b]))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300), st.integers(1, 130))
def test_rank_index_is_exact_within_its_bound(steps, error):
    offsets = np.cumsum(np.array(steps, np.int64))
    index = RankIndex(offsets, error)
    ranks = np.random.default_rng(0).permutation(len(offsets))
    assert (index.offset(ranks) == offsets[ranks]).all()
    assert abs(index.residuals).max(initial=0) <= error and len(index.first) <= max(1, len(offsets))


def test_rank_index_needs_few_segments():
    rng = np.random.default_rng(3)
    even = np.cumsum(rng.integers(2, 12, 200_000))
    assert len(RankIndex(np.arange(0, 10**6, 5)).first) == 1 and len(RankIndex(even).first) < 2000
