"""The pipeline on empty tables, and on rows without id, repeated rows and documents that line dedup empties."""

import pytest

import corpus
import corpus_pipeline
from jornada.llm.inputs import DOCUMENTS, LABELS


def folder_of(spark, path, rows, labels=()):
    names = corpus_pipeline.COLUMNS
    corpus.frame(spark, rows).select(*names).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def stages(spark, folder):
    """What each stage returns, each written and read again."""
    docs, found = spark.read.schema(DOCUMENTS).parquet(f"{folder}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage-{number}")
        docs = spark.read.parquet(f"{folder}/stage-{number}")
        found[name] = docs.collect()
    return found


def test_empty_tables(spark, tmp_path):
    found = stages(spark, folder_of(spark, tmp_path, []))
    assert [len(x) for x in found.values()] == [0] * 5
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    rows = corpus.texts()
    line = "A line that stands alone in several documents."
    rows += [(2000 + i, line, "s") for i in range(3)] + [(None, line, "s")]
    return rows, stages(spark, folder_of(spark, tmp_path_factory.mktemp("pipeline"), rows))


def test_nothing_is_rejected_without_labels(awkward):
    rows, found = awkward
    assert len(found["quality classifier"]) == len(rows)
    assert len(found["line dedup"]) == len(rows)


def test_emptied_documents_and_rows_without_id(awkward):
    _, found = awkward
    left = {r["doc_id"]: r["text"] for r in found["line dedup"] if r["doc_id"] is not None}
    assert left[2000].startswith("A line") and left[2001] == left[2002] == ""
    near = found["near duplicates"]
    # Documents without words are alone, so they stay; each id comes once, and rows without id stay.
    ids = [r["doc_id"] for r in near if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and {1, 2, 3, 2001, 2002} <= set(ids)
    assert sum(r["doc_id"] is None for r in near) == sum(r["doc_id"] is None for r in found["line dedup"])


def test_sequences_hold_all_of_the_mix(awkward):
    _, found = awkward
    mixed, packed = found["mixing"], found["packing"]
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}
    assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)
    assert all(r["n_chars"] == len(r["text"] or "") for r in mixed if r["text"] is not None)
