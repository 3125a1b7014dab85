"""The registered queries, those with SQL against DuckDB, and the pipeline on the smallest tables."""

import collections
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus
import corpus_pipeline
from jornada.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert [sum(n.startswith(f"op{i}_") for n in queries.QUERIES) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, FOLDER)
    assert sorted(names) == sorted(got.columns)
    assert collections.Counter(map(tuple, got.select(*names).collect())) == collections.Counter(cursor.fetchall())


COLUMNS = {
    "op1_quality": "doc_id held_out score predicted",
    "op2_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op4_url_filter": "page_id host path rule verdict",
    "op9_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_language_id": "doc_id held_out lang_pred score",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    table = "pages" if name.startswith("op4") else "documents"
    assert got.count() == duckdb.execute(f"select count(*) from '{FOLDER}/{table}.parquet'").fetchone()[0]


def test_pipeline_stages(spark, tmp_path):
    docs = queries.documents(spark, FOLDER)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(docs.collect())
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    quality, lines, near, mix, packed = kept
    assert 100 < len(quality) and len(lines) == len(quality) and len(near) <= len(lines)
    # Line dedup and near duplicates by plain versions.
    from test_jaccard_join import brute
    from test_text_operators import plain_lines

    plain = plain_lines([(r["doc_id"], r["text"], None) for r in quality])
    assert sorted((r["doc_id"], r["text"]) for r in lines) == sorted((i, t) for i, t, _, _ in plain)
    groups = brute([(r["doc_id"], r["text"], None) for r in lines])
    assert sorted(r["doc_id"] for r in near) == sorted({c for _, _, c in groups})
    # The mix repeats documents at most twice, and the sequences hold all of it.
    times = collections.Counter(r["doc_id"] for r in mix)
    assert set(times) <= {r["doc_id"] for r in near} and max(times.values()) <= 2
    share = sum(len(corpus.words(r["text"])) for r in mix) / sum(len(corpus.words(r["text"])) for r in near)
    assert abs(share - 1.5) < 0.01
    assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)
