import corpus_pipeline
from helpers import awkward

from swingframe.llm import queries, store


def test_stages_keep_columns_and_drop_only_what_they_should(spark, folder):
    docs = store.table(spark, folder, "documents")
    names, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = store.written(stage(spark, docs, folder), "test")
        left = {r.doc_id for r in made.select("doc_id").collect()}
        assert left <= ids, name
        if name in ("mixing", "pieces"):
            assert left == ids, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == names, name
        docs, ids = made, left
    assert docs.filter("NOT round_trip").count() == 0


def test_stages_take_awkward_rows(spark, folder):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns
        docs = store.written(made, "test")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count() > 0


def test_every_operator_is_registered():
    assert {int(k[2:].split("_")[0]) for k in queries.QUERIES} == set(range(1, 14))
