"""Worked seconds per employee and day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECONDS = ("secondsWorked", "secondsToWork", "secondsBalance")


def daily_worked_hours(
    records: DataFrame, keys: Sequence[str] = ("employeeId", "date"), seconds: Sequence[str] = SECONDS
) -> DataFrame:
    """Sums per key; rows with a null key are dropped, the sum of nulls is 0.

    Map-side partial sums shrink a hot employee to one row per task.
    """
    known = records.na.drop("any", subset=list(keys))
    return known.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in seconds])


def worked_hours_with_checks(
    records: DataFrame,
    detail: Sequence[str],
    keys: Sequence[str] = ("employeeId", "date"),
    seconds: Sequence[str] = SECONDS,
) -> DataFrame:
    """Every check as its own row, next to the totals of its employee and day.

    The checks are not gathered into a list: a list of a hot key would have to
    fit in one row of one task.
    """
    totals = daily_worked_hours(records, keys, seconds).withColumnsRenamed({k: f"_total_{k}" for k in keys})
    checks = records.na.drop("any", subset=list(keys)).select(*keys, *detail)
    # Null-safe, so that the totals get an exchange of their own: AQE can then
    # split the checks of a hot employee and day over several tasks.
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_total_{k}")) for k in keys])
    return checks.join(totals, same_key, "left").select(*keys, *detail, *seconds)


def missing_days(records: DataFrame, spine: DataFrame, day: str = "date") -> DataFrame:
    """Days of the spine with their record count, 0 for days without records.

    Counts first, so that at most one row per day is joined.
    """
    counts = records.groupBy(day).agg(F.count("*").alias("records"))
    return spine.join(counts, day, "left").withColumn("records", F.coalesce("records", F.lit(0)))
