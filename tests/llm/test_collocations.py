import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from perfscore.llm import collocations as c

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_count, top, subsumed=80):
    """The contract's rows, by counting every phrase of every document."""
    counts, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    out, most = {}, Counter()
    for (lang, q), b in found.items():
        for k in range(2, len(q)):
            for i in range(len(q) - k + 1):
                most[lang, q[i:i + k]] = max(most[lang, q[i:i + k]], b)
    for (lang, p), a in found.items():
        if 100 * most[lang, p] >= subsumed * a and most[lang, p]:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s)
                  for lang, rows in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def check(spark, docs, min_count=2, top=2000, **how):
    df = spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate(docs)], "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in c.mine_collocations(df.repartition(3), min_count, top=top, **how).collect())
    assert got == brute(docs, min_count, top)
    return got


def sentences(seed, docs=120):
    rng = random.Random(seed)
    words = ["The", "of", "and", "new", "york", "City", "straße", "Ébène", "ébène", "a\x1cb", "漢字"]
    stock = [" ".join(rng.choices(words, k=k)) for k in (3, 3, 4, 5, 5, 6)]
    marks = [" ", "\t", "  ", ". ", ", ", "\n", "!", "\x0b"]
    out = []
    for _ in range(docs):
        parts = [rng.choice(stock) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(12))]
        out.append(("".join(p + rng.choice(marks) for p in parts), rng.choice(["en", "de", None, ""])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_sentences_against_brute_force(spark, seed):
    rows = check(spark, sentences(seed), min_count=3)
    assert {len(r[2].split(" ")) for r in rows} >= {2, 3, 4}


def test_top_and_ties(spark):
    docs = [("b c. a b. c d. a b c d", "en")] * 3 + [("x y", "fr")] * 3
    assert len(check(spark, docs, min_count=3, top=2)) == 3


def test_bits_that_phrases_share_change_no_count(spark, monkeypatch):
    monkeypatch.setattr(c, "_frequent", lambda *_: b"\xff" * (c.BITS // 8))
    check(spark, sentences(5), min_count=3)


def test_stripes_hold_counts_of_words_and_extensions(spark):
    docs = [("to be or not to be. to", "en")] * 4 + [("to see", "en")]
    df = spark.createDataFrame(docs, "text string, lang string")
    cells = {(r.size, r.prefix, r.word): r.n for r in c.count_stripes(df, min_count=4).collect()}
    assert sum(n for (size, _, _), n in cells.items() if size == 1) == 7 * 4 + 2
    assert {w: n for (size, _, w), n in cells.items() if size == 1} == {"to": 13, "be": 8, "or": 4, "not": 4, None: 1}
    assert {k[1:]: n for k, n in cells.items() if k[0] == 3} == {
        ("to be", "or"): 4, ("be or", "not"): 4, ("or not", "to"): 4, ("not to", "be"): 4}
    assert cells[2, "to", "be"] == 8


def test_scores_beyond_64_bits(spark):
    big = 6 * 10**18
    found = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, size int, a long")
    totals = spark.createDataFrame([("en", "a", big + 7), ("en", "b", big)], "lang string, part string, total long")
    (row,) = c._scores(found, totals).collect()
    assert row.score == 2000000 * big // (2 * big + 7)


def test_hashes_differ_and_repeat_wherever_the_bytes_lie():
    words = ["a", "b", "ab", "ba", "", "a\x00", "\x00a", "\x00", "a" * 5000, "a"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    h = c._hashes(data, ends - [len(w) for w in words], ends)
    assert h[0] == h[-1] and len(np.unique(h)) == len(h) - 1


@pytest.mark.parametrize("range_bits", [1, 5, 20])
def test_runs_of_hashes_are_merged(range_bits):
    rng = np.random.default_rng(4)
    chunks = [rng.integers(0, 1 << c.KEY_BITS, 3000, np.uint64) for _ in range(3)]
    often = rng.integers(0, 1 << c.KEY_BITS, 50, np.uint64)
    sent = [c.runs(np.concatenate([x, np.repeat(often, k)]), range_bits, 30).to_pylist()
            for x, k in zip(chunks, (9, 10, 11))]
    found = []
    for part in {r["part"] for rows in sent for r in rows}:
        own = [r for rows in sent for r in rows if r["part"] == part]
        keys = c.frequent_keys([r["steps"] for r in own], [r["n"] for r in own], 30)
        found += [(part << (c.KEY_BITS - range_bits)) + int(k) for k in keys]
    assert sorted(found) == sorted(map(int, often))


def test_slices_cut_between_texts(spark, documents):
    batch = pa.RecordBatch.from_pydict({"text": ["a b c. d"] * 5, "lang": ["en"] * 5})
    whole = c.words_of(batch.column("text"), batch.column("lang"))
    word, dictionary = whole.spelled()
    assert whole.follows.sum() == 10 and len(word) == 20 and dictionary.to_pylist() == ["a", "b", "c", "d"]


def test_odd_documents(spark, odd, none):
    rows = [(r.text, r.lang) for r in odd.collect()]
    got = sorted(tuple(r) for r in c.mine_collocations(odd, 2).collect())
    assert got == brute(rows, 2, 2000) and got
    assert c.mine_collocations(none).count() == 0
