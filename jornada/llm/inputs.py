"""The tables that the queries read, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jornada.llm.words import importable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    importable(spark)
    return spark.read.schema(DOCUMENTS).parquet(f"{folder}/documents.parquet")
