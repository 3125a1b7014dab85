"""From raw documents to training sequences, in five stages over whole tables.

Each stage takes what its predecessor kept, as a table that has been written and
read again, so a lost executor repeats no earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.llm import jaccard_join, line_dedup, mixing, packing, quality
from jornada.llm.queries import DOCUMENTS, LABELS, documents
from jornada.llm.words import importable, shared_folder

COLUMNS = [name.split()[0] for name in DOCUMENTS.split(", ")]


def _as_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters that the text has now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    importable(spark)
    labels = spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, labels).filter(F.col("score") >= quality.ACCEPT_FROM).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in an earlier one."""
    importable(spark)
    return _as_documents(line_dedup.dedup_lines(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    importable(spark)
    return jaccard_join.one_of_each(docs).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's budget takes them, cut where it ends."""
    return _as_documents(mixing.draw(mixing.mix(docs), COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of a power of two of token ids."""
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier, the joins' components and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's sequences; the others are written below the shared folder."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/stage-{number}")
        docs = spark.read.schema(DOCUMENTS).parquet(f"{folder}/stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
