"""Which days an entry was landed on, so that a request for a few days reads a few folders.

An edited entry may be landed again on any day, and its last extract counts. The
index has one row per entry, start and landed day; it is kept by a load, and
files that it does not know yet are read besides, so its age changes no result.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.functions import in_date_range, to_utc
from jornada.sources.files import exists
from jornada.sources.landing import read_landing
from jornada.sources.tables import append_new_rows, has_table, read_table

# Where an entry's start stands.
STARTS = {"work_entries": "workEntryIn.date", "time_entries": "timeEntryIn.date"}
_FILE_KEY = ("path", "modificationTime")


def _files(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    """Path, time and day of the landed files, by listing alone; None where they are not in folders by day."""
    if not exists(spark, f"{root}/{entity}"):
        return None
    files = spark.read.format("binaryFile").load(f"{root}/{entity}")
    if "date" not in files.columns:
        return None
    return files.select(*_FILE_KEY, F.col("date").cast("date").alias("date"))


def _unknown_days(spark: SparkSession, files: DataFrame, index: str, entity: str) -> list[date]:
    """Days with files that the index does not know: no more than there are folders."""
    path = f"{index}/{entity}.files"
    if has_table(spark, path):
        files = files.join(read_table(spark, path), list(_FILE_KEY), "left_anti")
    return [row[0] for row in files.select("date").distinct().collect()]


def _starts(spark: SparkSession, root: str, entity: str, days: list[date]) -> DataFrame:
    raw = read_landing(spark, root, entity, on_days=days).where("id is not null")
    start = to_utc(F.col(STARTS[entity])).cast("date")
    return raw.select("id", start.alias("start_day"), F.col("date").alias("landed")).distinct()


def update_day_index(spark: SparkSession, root: str, index: str, entity: str) -> list[date]:
    """Take up the days with files that the index does not know; returns those days."""
    files = _files(spark, root, entity)
    if files is None:
        return []
    days = _unknown_days(spark, files, index, entity)
    if days:
        known = files.where(F.col("date").isin(days)).select(*_FILE_KEY)
        # Files that come meanwhile stay unknown: the list is taken before the records are read.
        rows = spark.createDataFrame(known.collect(), known.schema)
        starts = _starts(spark, root, entity, days)
        month = (F.year("start_day") * 100 + F.month("start_day")).alias("start_month")
        starts = starts.select("*", month)
        append_new_rows(spark, f"{index}/{entity}", starts, ["id", "start_day", "landed"], partition_by=["start_month"])
        append_new_rows(spark, f"{index}/{entity}.files", rows, list(_FILE_KEY))
    return days


def landed_days(
    spark: SparkSession, root: str, index: str, entity: str, first: date, last: date
) -> list[date] | None:
    """The days on which any version was landed of an entry of which some version starts in [first, last].

    None where the days are not known. At most one value per folder is collected.
    """
    files = _files(spark, root, entity)
    if files is None:
        return None
    days = _unknown_days(spark, files, index, entity)
    found, starts = set(days), None
    if has_table(spark, f"{index}/{entity}"):
        starts = read_table(spark, f"{index}/{entity}")
        months = (first.year * 100 + first.month, last.year * 100 + last.month)
        ids = in_date_range(starts.where(F.col("start_month").between(*months)), "start_day", first, last).select("id")
        if days:
            ids = ids.union(in_date_range(_starts(spark, root, entity, days), "start_day", first, last).select("id"))
        met = starts.join(ids.distinct(), "id", "left_semi").select("landed").distinct()
        found |= {row[0] for row in met.collect()}
    return sorted(found)
