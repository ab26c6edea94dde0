import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from perfscore.llm import packing as p
from perfscore.llm.tokens import Encoder, vocabulary

TEXT = st.text(alphabet=st.sampled_from(list(" \n\tab'sé.,1漢\x1c\u3000")), max_size=40)


def plain():
    return Tokenizer.from_file(vocabulary())


def test_strings_of_added_tokens_become_their_ids():
    texts = ["one two", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y one two\n<|endoftext|>", "<|endoftext", "one two a"]
    got = [x.tolist() for x in ENCODER.encode_batch(texts)]
    assert got == [PLAIN.encode(x, add_special_tokens=False).ids for x in texts] and got[2] == [50256]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_remembered_words_give_the_library_ids(texts):
    e, t = ENCODER, PLAIN
    assert [x.tolist() for x in e.encode_batch(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


ENCODER, PLAIN = Encoder(vocabulary()), plain()


def test_documents_and_a_full_memory_give_the_library_ids(documents, monkeypatch):
    from perfscore.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 20_000)
    texts = [r.text for r in documents.limit(80).collect()]
    e = Encoder(vocabulary())
    assert [x.tolist() for x in e.encode_batch(texts)] == [PLAIN.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(e._place) <= 500


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_bins_hold_all_lengths_and_no_two_could_be_one(lengths):
    bins = p.best_two_fit(np.array(lengths, int), 40)
    assert Counter(x for b in bins for x in b) == Counter(lengths)
    assert all(sum(b) <= 40 for b in bins)
    assert sum(sum(b) <= 20 for b in bins) <= 1


def test_two_smaller_pieces_replace_the_smallest_of_a_bin():
    # greedy: 60 + 30 leaves 10; 20 + 19 fill the expanded gap of 40 better than 30
    assert sorted(map(sorted, p.best_two_fit(np.array([60, 30, 20, 19]), 100))) == [[19, 20, 60], [30]]


def test_documents_are_cut_into_full_pieces_after_a_shorter_one():
    assert p.cut(5, 4) == [(0, 1), (1, 4)] and p.cut(8, 4) == [(0, 4), (4, 4)] and p.cut(3, 4) == [(0, 3)]


def check(rows, docs, capacity):
    texts = Counter((d, t or "") for d, t in docs)
    crcs = {}
    for (d, t), n in texts.items():
        ids = np.array([*PLAIN.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for k, (s, length) in enumerate(p.cut(len(ids), capacity)):
            key = (d, k, s, length, zlib.crc32(ids[s:s + length].tobytes()))
            crcs[key] = crcs.get(key, 0) + n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == crcs
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packed_documents(documents, monkeypatch):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows = p.pack_documents(documents).collect()
    n = check(rows, docs, p.CAPACITY)
    assert n <= 1.01 * sum(r.length for r in rows) / p.CAPACITY + 3
    monkeypatch.setattr(p, "GROUP", 40)
    check(p.pack_documents(documents).collect(), docs, p.CAPACITY)


def test_odd_documents(odd, none):
    check(p.pack_documents(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()], p.CAPACITY)
    assert p.pack_documents(none).count() == 0
