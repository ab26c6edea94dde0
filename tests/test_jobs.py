"""The end-to-end jobs reproduce the registered keys they are made of."""

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from perfscore import jobs
from perfscore.plans import page_fixtures as pf
from perfscore.plans.common import enriched
from perfscore.plans.fixtures import AS_OF, annotations

from conftest import SF_SMALL


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_jobs_match_keys(spark):
    qs = entry_mod.queries()
    out = jobs.ingest_job(pf.search_pages(spark, SF_SMALL), pf.stats_pages(spark, SF_SMALL),
                          pf.channel_pages(spark, SF_SMALL), pf.niche_map(spark, SF_SMALL),
                          pf.image_files(spark, SF_SMALL), AS_OF)
    assert _same(out["videos"], qs["videos_build"](spark, SF_SMALL))
    assert _same(out["audit"], qs["ingest_audit"](spark, SF_SMALL))
    assert _same(out["errors"], qs["error_split"](spark, SF_SMALL))

    labels = jobs.labelling_job(annotations(spark, SF_SMALL))
    assert _same(labels, qs["labels_build"](spark, SF_SMALL))

    rep = jobs.rule_scoring_job(enriched(spark, SF_SMALL), AS_OF, group_cols="niche")
    assert _same(rep["bands"], qs["score_bands_v5"](spark, SF_SMALL))
    assert _same(rep["correlations"], qs["pearson_pair"](spark, SF_SMALL))

    from perfscore.plans.model_keys import _emb
    emb = _emb(spark, SF_SMALL)
    tr = jobs.training_job(rep["scored"], emb, group="niche")
    assert tr["predictions"].count() > 0 and tr["metrics"].count() == 5
    lo, hi = tr["bounds"]
    assert lo < hi
    assert tr["predictions"].where(F.col("prediction").isNull()).count() == 0
