"""Helpers shared by the text operators: null texts, words, folders for checkpoints, columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.session import shared_root

#: Regular expression of a word: what lies between blanks, tabs and line ends of ASCII.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z lower-cased; bytes split and lower-case by ASCII alone."""
    return text.encode().lower().split() if text else []


def ascii_lower(text: Column) -> Column:
    """The text with A-Z lower-cased and all else as it is."""
    return F.translate(text, UPPER, LOWER)


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from the folder that the driver has it from."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where none is set, a folder below a warehouse that executors share too."""
    return shared_root(spark)


def stored(frame: DataFrame) -> DataFrame:
    """The frame written as a table below the shared folder and read back, so that lost executors cost no recomputation.

    Unlike after a checkpoint, the plan that follows knows nothing of the plan
    before, so loops plan equally fast in every round. The files stay, as
    checkpoints do, until the folder is cleaned.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    # No more tasks than keep all cores busy some times over: small tables are written by few.
    frame.coalesce(max(24, 8 * spark.sparkContext.defaultParallelism)).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def texts_of(column) -> Iterator[str]:
    """The strings of an Arrow column, one at a time, nulls as empty texts."""
    for value in column:
        yield value.as_py() or ""
