"""Every query on odd and on empty tables, and the pipeline on both."""

import pytest

import corpus_pipeline
from plumbline.llm.base import table
from plumbline.llm.queries import REGISTRY

ROWS = {"op2_chat_tools": 12, "op8_warc": 8}
DOCUMENTS = [n for n in REGISTRY if n not in (*ROWS, "op9_packing", "op11_nra")]


@pytest.mark.parametrize("name", DOCUMENTS)
def test_one_row_per_document(spark, odd_folder, odd_documents, name):
    ids = sorted((r[0] for r in REGISTRY[name](spark, f"{odd_folder}/full").select("doc_id").collect()), key=str)
    assert ids == sorted((r[0] for r in odd_documents.select("doc_id").collect()), key=str)


@pytest.mark.parametrize("name", sorted(ROWS))
def test_rows_of_other_tables(spark, odd_folder, name):
    assert REGISTRY[name](spark, f"{odd_folder}/full").count() == ROWS[name]


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_tables(spark, odd_folder, name):
    assert REGISTRY[name](spark, f"{odd_folder}/empty").count() == 0


def test_pipeline_on_odd_tables(spark, odd_folder):
    docs = table(spark, f"{odd_folder}/full", "documents")
    rows, seen = {tuple(r) for r in docs.collect()}, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{odd_folder}/full").cache()
        assert {tuple(r) for r in docs.collect()} <= rows, name
        assert docs.columns == table(spark, f"{odd_folder}/full", "documents").columns
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0


def test_pipeline_on_empty_tables(spark, odd_folder):
    assert corpus_pipeline.run(spark, f"{odd_folder}/empty").count() == 0


def test_pipeline_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "packing"]


def test_pipeline_sends_small_batches(spark, monkeypatch):
    """Batches of whole rows are small while a stage runs, and the setting is put back."""
    import corpus_pipeline

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def stage(session, docs, sf_dir):
        seen.append(int(session.conf.get(name)))
        return docs

    before = spark.conf.get(name, None)
    monkeypatch.setattr(corpus_pipeline, "table", lambda session, sf_dir, kind: session.range(10))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", stage), ("last", lambda session, docs, sf_dir: docs)])
    assert corpus_pipeline.run(spark, "made-up").count() == 10
    assert seen == [2000] and spark.conf.get(name, None) == before
