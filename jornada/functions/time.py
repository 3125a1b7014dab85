"""Dates, day sequences and durations."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def duration_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def seconds_to_hours(seconds: Column) -> Column:
    return seconds / F.lit(3600.0)


def hour_minute(moment: Column) -> Column:
    return F.date_format(moment, "HH:mm")


def in_date_range(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows whose UTC day lies in [first, last].

    Written as a half-open range on the column itself, so that the scan prunes
    partitions (a date column) or skips row groups (a timestamp column).
    """
    kind = df.schema[column].dataType
    start = F.lit(first).cast(kind)
    end = F.lit(last + timedelta(days=1)).cast(kind)
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def day_spine(spark: SparkSession, first: date, last: date, name: str = "date") -> DataFrame:
    """Every day of [first, last], one row each."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))
