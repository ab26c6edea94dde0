from collections import Counter

import corpus_pipeline as c
import __spark_entry__ as entry
from perfscore.llm.common import materialize
from perfscore.llm.queries import ORACLES, QUERIES

from .conftest import SF_SMALL


def test_stages_in_order_and_registered_queries():
    assert [n for n, _ in c.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "mixing", "packing"]
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES} and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES)


def test_each_stage_takes_all_that_its_predecessor_kept(spark, documents):
    docs, columns, kept = documents, documents.columns, []
    for name, stage in c.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == columns and docs.dtypes == documents.dtypes
        kept.append(Counter(r.doc_id for r in docs.collect()))
    assert set(kept[1]) <= set(kept[0]) and set(kept[2]) <= set(kept[1])
    assert max(kept[2].values()) == 1 and set(kept[3]) == set(kept[2])  # the mix gives every document
    pieces = c.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == kept[3]
    again = c.run(spark, SF_SMALL)
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again.collect()) == Counter(
        (r.doc_id, r.piece, r.ids_crc32) for r in pieces)


def test_odd_documents_pass_all_stages(spark, odd, none):
    for docs in (odd, none):
        for _, stage in c.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), "test-odd")
        assert "sequence_id" in docs.columns
