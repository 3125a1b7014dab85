"""Landing zone of the extracts.

Layout: ``<root>/<entity>/tenant=<t>/[date=<d>/]*.json``, every file holding
pages ``{"data": [record, ...]}``, one page per line. All tenants are read in
one scan; ``tenant`` and ``date`` (of entities that are extracted by day) are
partition columns, so filters on them skip files. Records of different tenants
are not merged.

Records without id, which are totalled, may be extracted again: each extract of
a tenant's day then has a folder of its own, ``date=<d>/extract=<e>``, or names
itself in its pages, ``{"data": [...], "extract": "<e>"}``. The extract with the
last name, in text order, is the day's; one without name is the oldest.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from jornada.functions import check_date_range
from jornada.operators.latest import latest_generation, latest_per_key
from jornada.schemas import envelope_schema, landing_schema
from jornada.sources.files import exists

DATED_ENTITIES = ("worked_hours", "work_entries", "time_entries")
# Entities without id: of a tenant's day only the last extract counts.
GENERATION_ENTITIES = ("worked_hours",)
GENERATION_OF = ("tenant", "date")


def _file_schema(entity: str) -> StructType:
    return StructType([*envelope_schema(entity).fields, *partition_fields(entity)])


def partition_fields(entity: str) -> list[StructField]:
    """What a folder says of its pages."""
    fields = [StructField("tenant", StringType())]
    if entity in DATED_ENTITIES:
        fields.append(StructField("date", DateType()))
    if entity in GENERATION_ENTITIES:
        fields.append(StructField("extract", StringType()))
    return fields


def records(pages: DataFrame, entity: str, *also: str) -> DataFrame:
    """Pages -> one row per record, with the partition columns."""
    extra = [*[f.name for f in partition_fields(entity)], *also]
    return pages.select(F.explode("data").alias("record"), *extra).select("record.*", *extra)


def read_landing(
    spark: SparkSession,
    root: str,
    entity: str,
    tenants: Iterable[str] | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    mode: str = "PERMISSIVE",
    multi_line: bool = False,
    with_arrival: bool = False,
    last_only: bool = False,
    on_days: Iterable[date] | None = None,
) -> DataFrame:
    """Records of an entity from all tenants, or from the named ones.

    An entity or date range without files gives an empty table. Malformed pages
    are left out (see ``quarantine.read_checked`` for a reader that keeps them);
    with mode FAILFAST they fail the job. ``with_arrival`` adds ``arrival``, the
    time and name of the record's file. ``last_only`` reads, of entities without
    id, the last extract of each tenant's day only. ``on_days`` names the days
    whose folders are read; see ``day_index``.
    """
    path = f"{root}/{entity}"
    if not exists(spark, path):
        return spark.createDataFrame([], _record_schema(entity, with_arrival))
    pages = spark.read.schema(_file_schema(entity)).json(path, mode=mode, multiLine=multi_line)
    pages = chosen_pages(pages, entity, tenants, from_date, to_date, last_only)
    if on_days is not None:
        pages = pages.where(F.col("date").isin(sorted(on_days)))
    if not with_arrival:
        return records(pages, entity)
    return records(pages.withColumn("arrival", file_arrival()), entity, "arrival")


def chosen_pages(
    pages: DataFrame,
    entity: str,
    tenants: Iterable[str] | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    last_only: bool = False,
) -> DataFrame:
    """The pages of the tenants and days; with ``last_only`` those of each day's last extract.

    The last extracts are chosen among whole pages, so that an extract without
    records replaces the one before it as well.
    """
    days = check_date_range(from_date, to_date) if from_date or to_date else None
    if tenants is not None:
        pages = pages.where(F.col("tenant").isin(list(tenants)))
    if days and entity in DATED_ENTITIES:
        # Files that were landed without a date folder may hold any day.
        pages = pages.where(F.col("date").isNull() | F.col("date").between(*days))
    if last_only and entity in GENERATION_ENTITIES:
        pages = latest_generation(pages, GENERATION_OF, "extract")
    return pages


def file_arrival() -> Column:
    return F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"))


def last_extract(flat: DataFrame) -> DataFrame:
    """Of several extracts of a record the last to arrive; ``arrival`` is dropped."""
    marked = flat.withColumn("_content", F.xxhash64(*[c for c in flat.columns if c != "arrival"]))
    return latest_per_key(marked, ["id"], "arrival", "_content").drop("arrival", "_content")


def read_bad_pages(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Text of the malformed pages, by tenant."""
    schema = _file_schema(entity).add("bad_page", StringType())
    pages = spark.read.schema(schema).json(f"{root}/{entity}", columnNameOfCorruptRecord="bad_page")
    return pages.where("bad_page is not null and data is null").select("tenant", "bad_page")


def stream_landing(spark: SparkSession, root: str, entity: str, max_files: int | None = None) -> DataFrame:
    """The same records as a stream of newly arriving files."""
    reader = spark.readStream.schema(_file_schema(entity))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return records(reader.json(f"{root}/{entity}"), entity)


def _record_schema(entity: str, with_arrival: bool) -> StructType:
    extra = [f for f in _file_schema(entity).fields if f.name != "data"]
    schema = StructType([*landing_schema(entity).fields, *extra])
    return schema.add("arrival", "struct<time: timestamp, file: string>") if with_arrival else schema


def union_tenants(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name, duplicates kept."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def with_company_id(df: DataFrame, accounts: DataFrame) -> DataFrame:
    """Each tenant's own company id, from its account record."""
    companies = accounts.groupBy("tenant").agg(F.max("company.id").alias("company_id"))
    return df.join(companies, "tenant", "left")
