"""The pipeline and every registered corpus query, on the smallest tables."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from devpulse.llm.common import table

FOLDER = contract.SMOKE_FOLDER


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    texts, ids = {r.doc_id: r.text for r in docs.collect()}, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        rows = out.collect()
        kept = {r.doc_id for r in rows}
        assert len(rows) == len(kept) and (ids is None or kept <= ids)
        changed = [r.doc_id for r in rows if r.text != texts[r.doc_id]]
        assert not changed or name == "secrets"
        docs, ids = out, kept
    assert 0 < len(ids) < len(texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


@pytest.mark.parametrize("name", sorted(contract.CORPUS_QUERIES))
def test_queries_give_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0
