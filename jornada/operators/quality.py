"""Valid / rejected splits, null rules and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.schemas import REQUIRED_EMPLOYEE_FIELDS


def reject_missing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all the columns present, and the other rows."""
    complete = reduce(and_, [F.col(c).isNotNull() for c in columns])
    return df.where(complete), df.where(~complete)


def assert_complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job at the first row that lacks one of the columns."""
    complete = reduce(and_, [F.col(c).isNotNull() for c in columns])
    message = F.lit(f"a record lacks one of: {', '.join(columns)}")
    return df.where(F.when(complete, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def missing_fields(required: Sequence[str] = REQUIRED_EMPLOYEE_FIELDS) -> Column:
    """Comma-joined names of the required fields that are null or empty."""
    flags = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in required]
    return F.concat_ws(",", *flags)


def validate_required(
    df: DataFrame, required: Sequence[str] = REQUIRED_EMPLOYEE_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with a ``missing_fields`` column."""
    marked = df.withColumn("missing_fields", missing_fields(required))
    return marked.where("missing_fields = ''").drop("missing_fields"), marked.where("missing_fields <> ''")


def request_body(df: DataFrame) -> Column:
    """JSON text of a row without its null fields."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "true"})


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)
