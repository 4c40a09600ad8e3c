import corpus_pipeline
from tabloom.llm.common import materialise

from .helpers import near_components, normal, odd_rows, table


def test_stages_on_odd_rows(spark, sf_dir):
    """Every stage takes nulls, copies and clashing names; columns stay; decisions take effect."""
    docs = table(spark, odd_rows())
    given = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, sf_dir), "test")
        assert out.columns == docs.columns, name
        if name == "exact_dedup":
            texts = [normal(r["text"]) for r in out.collect()]
            assert len(texts) == len(set(texts)) and set(texts) == {normal(r["text"]) for r in docs.collect()}
        if name == "near_dedup":
            before = [(r["doc_id"], r["text"]) for r in docs.collect()]
            parts = near_components(before)
            assert {r["doc_id"] for r in out.collect() if r["doc_id"] is not None} == set(parts.values())
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and given > 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 100 and "ids_sha256" in out.columns


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = table(spark, odd_rows()).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
