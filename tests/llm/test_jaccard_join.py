import random
from itertools import combinations

import numpy as np
import pytest
from perfscore.llm import jaccard_join as j
from perfscore.llm.common import materialize
from perfscore.llm.components import connected_components


def grams(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    """Links of each row, and the smallest doc_id it is connected to."""
    sets = [grams(t) for _, t in docs]
    links = [set() for _ in docs]
    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12:
            links[a].add(b)
            links[b].add(a)
    label = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for a, own in enumerate(links):
            low = min([label[a], *[label[b] for b in own]])
            changed |= low != label[a]
            label[a] = low
    groups = {}
    for a, g in enumerate(label):
        groups.setdefault(g, []).append(docs[a][0])
    return sorted((d, min(groups[label[a]]), len(links[a])) for a, (d, _) in enumerate(docs))


def variants(n, seed=3):
    """A chain of texts, each a few words from the one before, among unlike ones."""
    rnd = random.Random(seed)
    words = [f"w{rnd.randrange(9000)}" for _ in range(120)]
    docs = []
    for i in range(n):
        if i % 4 == 0:
            docs.append((i, " ".join(f"u{rnd.randrange(9000)}" for _ in range(rnd.randrange(1, 90)))))
        else:
            words = [*words]
            words[rnd.randrange(120)] = f"x{i}"
            docs.append((i, " ".join(words)))
    return docs + [(1000 + d, t) for d, t in docs[::5]]


def found(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted((r.doc_id, r.class_id, r.n_links) for r in j.near_classes(df, **kw).collect())


def test_classes_and_links_equal_brute_force(spark):
    docs = variants(60)
    assert found(spark, docs) == brute(docs)


def test_groups_beyond_a_block_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(j, "BLOCK", 7)
    docs = variants(60, seed=4)
    assert found(spark, docs) == brute(docs)


def test_documents_equal_brute_force(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(spark, docs) == brute(docs)


def test_band_count_reaches_the_recall():
    spec = j.Bands()
    assert 1 - (1 - 0.8 ** spec.rows) ** spec.bands >= spec.recall > 1 - (1 - 0.8 ** spec.rows) ** (spec.bands - 1)


def test_common_counts_equal_set_sizes():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 40, 60, 60)]
    got = j._common(sets)
    for a, b in combinations(range(5), 2):
        assert got[a, b] == len(np.intersect1d(sets[a], sets[b]))


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 9)], []])
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_one_of_each_group_stays(spark):
    docs = variants(40)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = sorted(r.doc_id for r in j.one_of_each(df).collect())
    assert kept == sorted({c for _, c, _ in brute(docs)})


def test_odd_documents(odd, none):
    rows = j.near_classes(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.class_id, r.n_links))
    assert by[1] == [(1, 0)] and by[2] == [(2, 0)] and by[3] == [(3, 0)] and by[4] == [(4, 0)]
    assert by[7] == [(7, 2), (7, 2)] and (7, 2) in by[None] and (None, 0) in by[None]
    assert by[9] == [(9, 1)] and by[10] == [(9, 1)]
    kept = j.one_of_each(odd)
    assert kept.dtypes == odd.dtypes
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 1
    assert j.near_classes(none).count() == 0 == j.one_of_each(none).count()


def test_repeated_rows_meet_as_one_row_a_task(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a")] * 40 + [(None, text, "b")] * 3 + [(None, "x y z", "c")] * 5 + [(2, "", "d")] * 4 + [(None, None, "e")] * 2
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), "repeated")
    kept = j.one_of_each(docs)
    got = sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=str)
    assert got == sorted([(1, text, "a"), (None, "x y z", "c")] + [(2, "", "d")] * 4 + [(None, None, "e")] * 2, key=str)
    assert "Window" not in kept._jdf.queryExecution().optimizedPlan().toString()
