import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from perfscore.llm import token_store as ts
from perfscore.llm.tokens import crc32, vocabulary
from perfscore.session import scratch_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=12), st.integers(2, 5))
def test_blocks_round_trip_whole_and_by_document(docs, min_count):
    arrays = [np.array(d, np.uint32) for d in docs]
    block = ts.Block(ts.pack_block(arrays, 6, min_count))
    assert block.all_ids().tolist() == [x for d in docs for x in d]
    for k, d in enumerate(docs):
        assert block.document(k).tolist() == d


def test_no_frequent_pair_is_left():
    ids = np.array([1, 2, 3, 4] * 200 + [5] * 301, np.uint32)
    rules, seq = ts.re_pair(ids, 6, 4)
    assert len(rules) and len(seq) < len(ids) / 10
    pairs = list(zip(seq[:-1].tolist(), seq[1:].tolist()))
    apart = {p: sum(x == p for x in pairs) for p in set(pairs) if p[0] != p[1]}
    assert all(n < 4 for n in apart.values())


def expected(docs):
    t = Tokenizer.from_file(vocabulary())
    rows, at = [], 0
    for d, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)
        rows.append((d, at, len(ids), crc32(ids)))
        at += len(ids)
    return rows


def stored(spark, df, **kw):
    target = scratch_path(spark, "tokens-test")
    ts.write_tokens(df, target, **kw)
    return sorted(map(tuple, ts.read_tokens(spark, target).collect()), key=lambda r: r[1])


def test_documents_round_trip(spark, documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    assert stored(spark, documents.repartition(4), shard_ids=20_000) == expected(docs)


def test_odd_documents(spark, odd, none):
    docs = sorted(((r.doc_id, r.text) for r in odd.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert stored(spark, odd) == expected(docs)
    assert stored(spark, none) == []


def test_strings_of_added_tokens_are_stored_as_the_library_has_them(spark):
    docs = [(1, "a <|endoftext|> b"), (2, "one two"), (3, "<|endoftext|>")]
    path = scratch_path(spark, "special")
    ts.write_tokens(spark.createDataFrame(docs, "doc_id long, text string"), path)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in ts.read_tokens(spark, path).orderBy("doc_id").collect()]
    assert got == expected(docs)
