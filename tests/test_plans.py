"""Plan shapes that matter at scale (hot groups, no whole-group tasks)."""

from pyspark.sql import functions as F

from perfscore.operators import ingest as ig
from perfscore.operators import stats as st


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark):
    # one channel holds two thirds of the rows
    return spark.range(3000).select(
        F.col("id").cast("string").alias("video_id"),
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")))
        .alias("channel_id"),
        (F.col("id") % 97).cast("double").alias("x"),
        (F.col("id") % 7).cast("int").alias("page_no"), F.col("id").alias("pos"))


def test_zscore_is_broadcast_aggregate_not_window(spark):
    p = _plan(st.zscore_within(_hot(spark), "x", "channel_id"))
    assert "BroadcastHashJoin" in p and "Window" not in p


def test_cap_has_partial_group_limit_before_shuffle(spark):
    p = _plan(ig.cap_per_group(_hot(spark), 5))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_flag_report_is_single_aggregate(spark):
    df = _hot(spark)
    flags = {f"f{i}": F.col("x") > i * 10 for i in range(8)}
    p = _plan(st.flag_means(df, flags, "x"))
    assert p.count("HashAggregate") <= 2 and "Expand" not in p


def _small_tables(spark, folder, n_docs=40, n_orders=60, copies=1):
    """Tables of the driver's schema: long texts, vectors with repeated ids (``copies`` of each)."""
    docs = spark.range(n_docs).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("long words "), 300).alias("text"),
        F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(3300).alias("n_chars"))
    customer = spark.range(6).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("c_name"),
                                     (F.col("id") * 900.0 + 10).alias("c_acctbal"), F.lit("AI/Tech").alias("c_mktsegment"))
    orders = spark.range(n_orders).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 6).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (F.col("id") * 7919 % 1000 * 300.0 + 1).alias("o_totalprice"),
        F.expr("timestamp_ntz'1999-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    emb = spark.range(n_orders).select(F.col("id").alias("vec_id"), F.array(
        *[((F.col("id") * (i + 3)) % 11).cast("float") for i in range(4)]).alias("embedding"), F.lit(0).alias("label"))
    emb = emb.withColumn("_c", F.explode(F.array(*[F.lit(i) for i in range(copies)]))).drop("_c")
    for name, df in (("documents", docs), ("customer", customer), ("orders", orders), ("embeddings", emb)):
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_texts_are_measured_before_they_are_joined(spark, tmp_path):
    from perfscore.plans.common import enriched_perf, rule_scored
    from perfscore.operators.scoring import with_rule_score
    sf = _small_tables(spark, tmp_path)
    rows = rule_scored(spark, sf)
    assert "texte_contenu" not in rows.columns
    wide = with_rule_score(enriched_perf(spark, sf)).select("video_id", "text_length", "thumbnail_score")
    got = rows.select("video_id", "text_length", "thumbnail_score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wide.collect())) and got.count() > 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [i for i, line in enumerate(plan.split("\n")) if "Join " in line]
    assert "length(" in plan and min(i for i, line in enumerate(plan.split("\n")) if "length(" in line) > joins[0]


def test_repeated_vectors_give_a_row_each_and_folds_of_equal_size(spark, tmp_path):
    from perfscore.operators import features as fe
    from perfscore.operators import models as md
    from perfscore.plans.model_keys import _emb, _rows
    sf = _small_tables(spark, tmp_path, copies=2)
    rows, emb = _rows(spark, sf), _emb(spark, sf)
    whole = fe.training_input(rows, emb)
    assert whole.count() == 2 * rows.count() and whole.select("video_id").distinct().count() == rows.count()
    vectors = fe.keyed_vectors(emb)
    preds = md.cross_val_predictions(fe.training_rows(rows, vectors), "ridge", vectors=vectors)
    sizes = [r["count"] for r in preds.groupBy("fold").count().collect()]
    assert sum(sizes) == whole.count() and max(sizes) - min(sizes) <= 1
    safe = md.cross_val_predictions_fold_safe(rows, emb)
    assert safe.count() == whole.count()


def test_predictions_of_a_fold_do_not_meet_in_one_task(spark):
    import numpy as np
    from perfscore.operators import gram
    rows = spark.range(100).select((F.col("id") % 2).alias("fold"), F.array(F.col("id").cast("double")).alias("x"))
    models = [gram.Linear(1.0, np.array([2.0]), np.array([2.0])), gram.Linear(0.0, np.array([3.0]), np.array([3.0]))]
    out = gram.with_predictions(rows, models, "fold", F.col("x"))
    assert "Exchange hashpartitioning" not in _plan(out)
    assert all(r.prediction == (3 * r.x[0] if r.fold else 1 + 2 * r.x[0]) for r in out.collect())


def test_folds_shuffle_no_rows_that_are_joined_by_id(spark):
    from perfscore.operators.features import assign_folds
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(500).select(F.col("id").cast("string").alias("video_id"), F.lit(1).alias("a"))
        b = spark.range(500).select(F.col("id").cast("string").alias("video_id"), F.lit("wide").alias("b"))
        out = assign_folds(a.join(b, "video_id"), k=5)
        assert _plan(out).count("hashpartitioning(video_id") == 3  # a, b and the ranks
        assert sorted(r["count"] for r in out.groupBy("fold").count().collect()) == [100] * 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_csv_files_end_after_so_many_rows(spark, tmp_path, monkeypatch):
    from perfscore.sources import files as fl
    monkeypatch.setattr(fl, "CSV_ROWS_PER_FILE", 10)
    df = spark.range(95).coalesce(1).select(F.concat(F.lit("line\nbreak "), F.col("id").cast("string")).alias("t"))
    at = fl.write_table(df, str(tmp_path), fmt="csv", snapshot="1")
    assert len(list((tmp_path / "snapshot=1").glob("*.csv"))) == 10
    back = fl.read_csv_table(spark, at, "t string")
    assert sorted(r.t for r in back.collect()) == sorted(r.t for r in df.collect())


def test_csv_roundtrip_writes_texts_compressed(spark, tmp_path):
    import datetime as dt
    import os
    import random
    from decimal import Decimal

    from perfscore.plans import QUERIES, load_all
    from perfscore.plans.common import enriched
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    odd = ["", None, "NA", 'He said "hi",\nand\r\nleft ', " blanks ", "Élevé, été"]
    texts = [odd[i // 2 % 8] if i // 2 % 8 < 6 else " ".join(rng.choices(words, k=2000)) for i in range(160)]
    spark.createDataFrame([(i, t, "fr", "web") for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "Channel", Decimal("12.50"), "BUILDING"), (2, None, Decimal("-3.00"), None)],
                          "c_custkey long, c_name string, c_acctbal decimal(15,2), c_mktsegment string") \
        .write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(i, 1 + i % 2, "O", Decimal("99.90"), dt.datetime(2000, 1, 1), "1-URGENT") for i in range(160)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(15,2), o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    load_all()
    back, rows = QUERIES["csv_roundtrip"](spark, str(tmp_path)), enriched(spark, str(tmp_path))
    files = [f.removeprefix("file://") for f in back.inputFiles()]
    assert files and all(f.endswith(".csv.gz") for f in files)
    held = sum(len((r.texte_contenu or "").encode()) for r in rows.select("texte_contenu").collect())
    assert held > 100_000 and sum(map(os.path.getsize, files)) < held * 0.6
    plain = lambda df: sorted(map(repr, df.collect()))
    assert back.dtypes == rows.dtypes and rows.count() == 128
    assert plain(back) == plain(rows)


def test_compressed_csv_files_end_after_so_many_rows(spark, tmp_path, monkeypatch):
    from perfscore.sources import files as fl
    monkeypatch.setattr(fl, "CSV_ROWS_PER_FILE", 10)
    df = spark.range(95).coalesce(1).select(F.concat(F.lit("line\nbreak "), F.col("id").cast("string")).alias("t"))
    fl.write_table(df.limit(3), str(tmp_path), fmt="csv", snapshot="1")
    fl.write_table(df, str(tmp_path), fmt="csv", snapshot="2", compression="gzip")
    assert len(list((tmp_path / "snapshot=2").glob("*.csv.gz"))) == 10
    assert fl.read_csv_table(spark, str(tmp_path / "snapshot=1"), "t string").count() == 3
    back = fl.read_latest_snapshot(spark, str(tmp_path), fmt="csv", schema="t string")
    assert sorted(r.t for r in back.collect()) == sorted(r.t for r in df.collect())
