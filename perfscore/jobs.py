"""End-to-end jobs: the reference's four entry points as compositions of operators.

Each job returns a dict of DataFrames (lazy plans); writing them is up to the
caller (``sources.files.write_table``).  Nothing here adds logic of its own.

* ``ingest_job``      landed API pages → video table, per-channel audit, errors
* ``labelling_job``   raw annotations  → label table
* ``rule_scoring_job`` enriched videos → scored table, correlations, bands, summary, top 10
* ``training_job``    scored + embeddings → out-of-fold predictions, fold metrics,
                       final model and its 0-20 bounds
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from perfscore.functions.labels import label_columns
from perfscore.functions.scoring import V5, Weights
from perfscore.operators import features as fe
from perfscore.operators import ingest as ig
from perfscore.operators import models as md
from perfscore.operators import stats as st
from perfscore.operators.scoring import score_table
from perfscore.session import materialize
from perfscore.sources import pages as pg


def ingest_job(search_pages: DataFrame, stats_pages: DataFrame, channel_pages: DataFrame,
               niche_map: DataFrame, images: DataFrame, as_of: str,
               playlist_pages: DataFrame | None = None, cap: int | None = None) -> dict[str, DataFrame]:
    """Pages → flattened rows → (fallback) → joins and filters → video table.

    ``cap`` keeps at most so many videos per channel; landed pages are all read by default.
    """
    videos = pg.flatten_search_pages(search_pages)
    if playlist_pages is not None:
        videos = ig.prefer_search(videos, pg.flatten_playlist_pages(playlist_pages)).drop("source")
    if cap is not None:
        videos = ig.cap_per_group(videos, cap)
    cand = ig.ingest_candidates(videos, pg.flatten_stats_pages(stats_pages),
                                pg.flatten_channel_pages(channel_pages))
    return {"videos": ig.build_videos(cand, niche_map, images, as_of),
            "audit": ig.ingest_audit(cand),
            "errors": ig.error_rows(cand),
            "page_errors": pg.page_errors(search=search_pages, playlist=playlist_pages,
                                          stats=stats_pages, channel=channel_pages)}


def labelling_job(annotations: DataFrame, profile: str = "label") -> DataFrame:
    """Nested annotations → one label row per video."""
    return annotations.select("video_id", *label_columns(profile))


def rule_scoring_job(enriched: DataFrame, as_of: str, group_cols="channel_name",
                     weights: Weights = V5, top: int = 10) -> dict[str, DataFrame]:
    """v5 score, within-group z and the validation reports."""
    scored = score_table(enriched, as_of, group_cols=group_cols, weights=weights)
    return {"scored": scored,
            "correlations": st.pearson_pair(scored, "thumbnail_score", "performance_score", "perf_norm"),
            "bands": st.score_bands(scored, "thumbnail_score", "perf_norm"),
            "summary": st.score_summary(scored, "thumbnail_score"),
            "top": st.top_k(scored, "thumbnail_score", top)}


def training_job(scored: DataFrame, embeddings: DataFrame | None = None, kind: str = "ridge",
                 k: int = 5, seed: int = 42, fold_safe: bool = False,
                 group: str = "channel_name") -> dict:
    """Cross-validated predictions, fold metrics, score bounds and the final model, which holds them."""
    data = materialize(fe.training_input(scored, embeddings, group), "training")
    if fold_safe:
        preds = md.cross_val_predictions_fold_safe(scored, embeddings, group=group, kind=kind, k=k, seed=seed)
    else:
        preds = md.cross_val_predictions(data, kind, k=k, seed=seed, with_embedding=embeddings is not None)
    model = md.fit_final(data, kind, with_embedding=embeddings is not None)
    lo, hi = md.prediction_bounds(model.transform(data))
    return {"predictions": preds, "metrics": md.cv_metrics(preds), "model": md.with_bounds(model, lo, hi), "bounds": (lo, hi)}
