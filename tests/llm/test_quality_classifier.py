import zlib

import numpy as np

from perfscore.llm import quality_classifier as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = q.score_quality(docs, q.train_quality(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out and quality is not null").collect()
    assert len(rows) > 80 and np.mean([r.predicted == r.quality for r in rows]) >= 0.97
    for r in scored.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_tables_learn_single_and_joint_effects():
    rnd = np.random.default_rng(5)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)  # no single feature tells
    model = q.fit_additive(x, y, q.Training(pairs=1, pair_rounds=60))
    assert list(model.pairs) == [(0, 1)]
    fresh = rnd.random((1000, 3))
    truth = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.3)
    assert np.mean((model.scores(fresh) >= 0.5) == truth) > 0.9
    alone = q.fit_additive(x, (x[:, 2] > 0.4).astype(float), q.Training(pairs=0))
    assert np.mean((alone.scores(fresh) >= 0.5) == (fresh[:, 2] > 0.4)) > 0.95


def test_scores_are_sums_of_table_entries():
    model = q.AdditiveModel(0.5, [np.array([1.0]), np.array([2.0])], [np.array([0.0, 1.0]), np.array([-1.0, 2.0])],
                            {(0, 1): np.array([[0.1, 0.2], [0.3, 0.4]])})
    got = model.scores(np.array([[0.0, 0.0], [1.0, 5.0]]))
    want = 1 / (1 + np.exp(-np.array([0.5 + 0 - 1 + 0.1, 0.5 + 1 + 2 + 0.4])))
    assert np.allclose(got, want)


def test_features_of_a_text():
    row = dict(zip(q.FEATURES, q.text_features(["Aa aa aa! 12\nb|c É.", None, ""])[0]))
    assert row["different_words"] == 1 and row["repeated_words"] == 0 and row["different_lines"] == 1
    assert row["exclamations"] == 1 / 6 and row["bars"] == 1 / 6 and row["digits"] == 2 / 6 and row["upper"] == 2 / 9
    assert not q.text_features([None, "", "x"])[:2, :9].any()


def test_odd_documents_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, "a"), (5, 0, "b"), (6, None, "c"), (None, 1, "d"), (4, 1, "e"), (99, 0, "f")],
                                   "doc_id long, quality int, text string")
    model = q.train_quality(odd, labels)
    assert q.score_quality(odd, model).count() == odd.count() and q.score_quality(none, model).count() == 0
    nothing = q.train_quality(odd, labels.limit(0))
    assert {r.score for r in q.score_quality(odd, nothing).collect()} == {0.5}


def test_repeats_neither_fill_the_sample_nor_reach_the_driver(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = [(i, f"text {i}") for i in ids] + [(ids[0], f"text {ids[0]}")] * 500
    labels = [(i, i % 2) for i in ids] + [(i, i % 2) for i in ids for _ in range(30)]
    seen = []
    monkeypatch.setattr(q, "fit_additive", lambda x, y, spec: seen.append(sorted(y)))
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(labels, "doc_id long, quality int"))
    q.train_quality(*frames, spec=q.Training(max_rows=len(ids)))
    assert seen == [sorted(float(i % 2) for i in ids)]
    q.train_quality(*frames, spec=q.Training(max_rows=10))
    assert len(seen[1]) == 10
