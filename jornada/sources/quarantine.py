"""Landing records that cannot be read, kept with the reason instead of vanishing.

A page that is no JSON, a page without records, a record that is none, and a
record with a value of the wrong type become rejected rows. Accepted and
rejected rows leave one scan together, are written once, and part by folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from jornada.schemas import landing_schema
from jornada.sources.files import exists
from jornada.sources.landing import chosen_pages, file_arrival, partition_fields

# The reasons.
BAD_PAGE, NO_DATA, NO_RECORD, WRONG_TYPE = "malformed page", "page without data", "no record", "wrong type"
REJECT = "reject"
REJECT_TYPE = "struct<errors: array<struct<field: string, reason: string, text: string>>, text: string>"
_KEPT, _REJECTED = "accepted", "rejected"


class TooManyRejects(Exception):
    """More of a load was rejected than its limit allows."""


def raw_page_schema(entity: str) -> StructType:
    """A page whose records are still text."""
    names = StructType.fromDDL("data array<string>, bad_page string").fields
    return StructType([*names, *partition_fields(entity)])


def error(field: Column | None, reason: Column | str, text: Column) -> Column:
    field = F.lit(None).cast("string") if field is None else field
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(field.alias("field"), reason.alias("reason"), text.alias("text"))


def checked_records(pages: DataFrame, schema: StructType, also: Sequence[str] = ()) -> DataFrame:
    """Pages (data: texts of records, bad_page) -> one row per record, and per page that has none to read.

    Columns: the record's, ``also`` and ``reject``, which is null for a record
    that could be read, else the errors and the text.
    """
    broken = F.col("bad_page").isNotNull()
    rows = pages.select(
        *also,
        F.when(broken, F.col("bad_page")).alias("_page"),
        broken.alias("_broken"),
        F.col("data").isNull().alias("_no_data"),
        F.explode_outer(F.when(~broken, F.col("data"))).alias("_text"),
        F.size("data").alias("_size"),
    ).where(F.col("_broken") | F.col("_no_data") | (F.col("_size") > 0))
    marked = StructType([*schema.fields]).add("_corrupt", StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = rows.withColumn("_record", F.from_json("_text", marked, options))

    # Fields that are there as text, and null as what they should be.
    given = F.from_json("_text", "map<string,string>")
    names = F.array(*[F.when(F.col(f"_record.{n}").isNull(), F.lit(n)) for n in schema.names])
    wrong = F.filter(names, lambda n: n.isNotNull() & given[n].isNotNull())
    typed = F.transform(wrong, lambda n: error(n, WRONG_TYPE, given[n]))
    nested = F.array(error(None, WRONG_TYPE, F.col("_text")))
    errors = (
        F.when(F.col("_broken"), F.array(error(None, BAD_PAGE, F.col("_page"))))
        .when(F.col("_no_data"), F.array(error(None, NO_DATA, F.lit(None).cast("string"))))
        .when(F.col("_text").isNull() | given.isNull(), F.array(error(None, NO_RECORD, F.col("_text"))))
        .when(F.col("_record._corrupt").isNotNull(), F.when(F.size(wrong) > 0, typed).otherwise(nested))
    )
    reject = F.when(errors.isNotNull(), F.struct(errors.alias("errors"), F.coalesce("_page", "_text").alias("text")))
    return rows.select("_record.*", *also, reject.cast(REJECT_TYPE).alias(REJECT)).drop("_corrupt")


def read_checked(
    spark: SparkSession,
    root: str,
    entity: str,
    tenants: Iterable[str] | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    with_arrival: bool = False,
    last_only: bool = False,
    on_days: Iterable[date] | None = None,
) -> DataFrame:
    """The records that ``read_landing`` reads, and the rejected ones, with ``reject``."""
    path, schema = f"{root}/{entity}", landing_schema(entity)
    also = [f.name for f in partition_fields(entity)]
    if not exists(spark, path):
        empty = StructType([*schema.fields, *partition_fields(entity)])
        frame = spark.createDataFrame([], empty)
        if with_arrival:
            frame = frame.withColumn("arrival", F.lit(None).cast("struct<time: timestamp, file: string>"))
        return frame.withColumn(REJECT, F.lit(None).cast(REJECT_TYPE))
    pages = spark.read.schema(raw_page_schema(entity)).json(path, columnNameOfCorruptRecord="bad_page")
    pages = chosen_pages(pages, entity, tenants, from_date, to_date, last_only)
    if on_days is not None:
        pages = pages.where(F.col("date").isin(sorted(on_days)))
    if with_arrival:
        pages, also = pages.withColumn("arrival", file_arrival()), [*also, "arrival"]
    return checked_records(pages, schema, also)


def stream_checked(spark: SparkSession, root: str, entity: str, max_files: int | None = None) -> DataFrame:
    """The same rows as a stream of newly arriving files."""
    reader = spark.readStream.schema(raw_page_schema(entity)).option("columnNameOfCorruptRecord", "bad_page")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pages = reader.json(f"{root}/{entity}")
    return checked_records(pages, landing_schema(entity), [f.name for f in partition_fields(entity)])


def split_once(checked: DataFrame, folder: str, most_rejected: float = 1.0) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Accepted rows, rejected rows, and how many were read and rejected.

    One pass writes both below the folder. Beyond ``most_rejected``, a share of
    the rows read, the load fails; the rows stay in the folder to be looked at.
    """
    counts = Observation()
    refused = F.col(REJECT).isNotNull()
    measured = checked.observe(counts, F.count("*").alias("read"), F.count(F.when(refused, True)).alias("rejected"))
    parted = measured.withColumn("_sink", F.when(refused, _REJECTED).otherwise(_KEPT))
    parted.write.mode("overwrite").partitionBy("_sink").parquet(folder)
    spark = checked.sparkSession
    written = spark.read.schema(parted.schema).parquet(folder)
    found = counts.get
    if found["rejected"] > most_rejected * found["read"]:
        raise TooManyRejects(f"{found['rejected']} of {found['read']} rows rejected; see {folder}/_sink={_REJECTED}")
    accepted = written.where(F.col("_sink") == _KEPT).drop("_sink", REJECT)
    return accepted, written.where(F.col("_sink") == _REJECTED).drop("_sink"), found


def reject_rows(rejected: DataFrame, entity: str) -> DataFrame:
    """Rejected rows as one table takes them: entity, tenant, date, errors, text and their digest."""

    def of(name: str, kind: str) -> Column:
        return (F.col(name) if name in rejected.columns else F.lit(None)).cast(kind).alias(name)

    rows = rejected.select(
        F.lit(entity).alias("entity"), of("tenant", "string"), of("date", "date"), f"{REJECT}.errors", f"{REJECT}.text"
    )
    content = F.to_json(F.struct("errors", "text"))
    return rows.withColumn("digest", F.sha2(content, 256)).dropDuplicates(["entity", "tenant", "date", "digest"])
