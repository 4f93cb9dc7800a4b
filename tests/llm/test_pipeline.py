"""The pipeline on the small tables and on odd rows, and the registered queries."""

import corpus_pipeline
from gridmart.llm import registry
from gridmart.llm.common import staged

from odd_cases import SF
from test_private_data import base


def test_stages_keep_columns_and_take_effect(spark, small_documents):
    docs = small_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF), "test")
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count(), name
        if name == "PII":
            assert not any(base(r["text"]) for r in out.collect())
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}


def test_stages_on_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, out, SF), "test")
            if name != "packing":
                assert out.columns == docs.columns
        assert (out.count() == 0) == (docs is nothing)


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
