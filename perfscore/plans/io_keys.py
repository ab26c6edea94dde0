"""Driver keys: file formats read back after a write."""

from __future__ import annotations

from pyspark.sql import functions as F

from perfscore.functions.features import TAB_FEATURES
from perfscore.operators.features import training_features
from perfscore.plans.common import enriched, rule_scored
from perfscore.plans.feature_keys import TRAIN_CTE
from perfscore.plans.registry import key
from perfscore.session import scratch_path
from perfscore.sources import files as fl
from perfscore.sources.embeddings import embedding_table
from perfscore.sources.tables import read_table

E = ("f_enriched",)
EMB_DIM = 64    # width of the driver's embedding table


@key("csv_roundtrip", "SELECT * FROM f_enriched", E)
def q_csv_roundtrip(spark, sf_dir):
    """Write the enriched table as CSV (snapshot folder), read it back typed.

    Each video's row carries its whole text, so the files are compressed.
    """
    df = enriched(spark, sf_dir)
    base = scratch_path(spark, "enriched_csv")
    fl.write_table(df, base, fmt="csv", snapshot="20010802T000000", compression="gzip")
    fl.write_table(df.limit(0), base, fmt="csv", snapshot="20010801T000000", compression="gzip")
    return fl.read_latest_snapshot(spark, base, fmt="csv", schema=df.schema)


@key("embedding_scan", f"SELECT CAST(vec_id AS VARCHAR) AS video_id, CAST(len(embedding) AS INT) AS dim, "
     f"(embedding IS NOT NULL AND len(embedding) = {EMB_DIM}) AS valid, label FROM embeddings")
def q_embedding_scan(spark, sf_dir):
    emb = embedding_table(read_table(spark, sf_dir, "embeddings"), dim=EMB_DIM)
    return emb.select("video_id", "dim", "valid", "label")


# All values count: each one times its place, summed.
_TAB_MARK = " + ".join(f"{i + 1} * {n}" for i, n in enumerate(TAB_FEATURES))


def _mark(values):
    placed = F.transform(values, lambda x, i: x.cast("double") * (i + 1))
    return F.aggregate(placed, F.lit(0.0), lambda a, x: a + x)


@key("jsonl_instances", TRAIN_CTE + ", s AS (SELECT * FROM feats) "
     "SELECT s.video_id, CAST(len(e.embedding) AS INT) AS dim, 20 AS n_tab, "
     "round(list_sum(list_transform(e.embedding, lambda x, i: CAST(x AS DOUBLE) * i)), 6) AS emb_mark, "
     f"round({_TAB_MARK}, 6) AS tab_mark FROM s JOIN embeddings e ON s.video_id = CAST(e.vec_id AS VARCHAR)", E)
def q_jsonl_instances(spark, sf_dir):
    """Nested instances to JSON lines and back; rows re-keyed by id, not position."""
    feats = training_features(rule_scored(spark, sf_dir))
    emb = embedding_table(read_table(spark, sf_dir, "embeddings"))
    rows = feats.join(emb.select("video_id", "embedding"), "video_id")
    path = scratch_path(spark, "instances")
    fl.write_instances(rows, path, tab_cols=[c for c in feats.columns if c != "video_id"])
    back = fl.read_instances(spark, path)
    inst = F.col("instance")
    return back.select("video_id", F.size(inst["embedding"]).alias("dim"),
                       F.size(inst["tabular"][0]).alias("n_tab"),
                       F.round(_mark(inst["embedding"]), 6).alias("emb_mark"),
                       F.round(_mark(inst["tabular"][0]), 6).alias("tab_mark"))
