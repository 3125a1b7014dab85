"""Incremental loads with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jornada.operators.latest import latest_per_key
from jornada.plans.audit import Audit
from jornada.sources.tables import merge_into


def start_incremental_load(
    records: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
    surrogate: str | None = None,
    order: tuple[str, str] | None = None,
    audit: tuple[str, str, str] | None = None,
    most_rejected: float = 1.0,
) -> StreamingQuery:
    """Load the files that arrived since the last run, then stop.

    The merge depends on the batch's rows only, so a batch that is delivered
    again after a crash leaves the table as it is. ``order`` (date, tie-break)
    keeps the latest of several versions of a row, of those in one batch as of
    those that come in different ones: a file that arrives late with an older
    version leaves the newer row in the table.

    Records of ``quarantine.stream_checked`` need an ``audit`` (warehouse,
    entity, table's name): rejected ones are stored there before the others are
    merged, and each batch has its row of counts. A batch beyond
    ``most_rejected`` stops the stream, and comes again when that is raised.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if audit:
            warehouse, entity, name = audit
            run = Audit(spark, warehouse, f"{checkpoint}/{number}", most_rejected)
            batch = run.accept(batch, entity)
        rows = transform(batch)
        if order:
            rows = latest_per_key(rows, keys, *order)
        counts = merge_into(spark, path, rows, keys, partition_by, surrogate, version=order or ())
        if audit:
            run.close(name, counts)

    writer = records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def daily_seconds_stream(
    clockings: DataFrame, moment: str, employee: str, seconds: str, delay: str
) -> DataFrame:
    """Seconds per employee and UTC day of a stream; rows later than ``delay`` are dropped.

    The state holds one sum per employee and open day. ``correct_late_days``
    brings in what came after its day was closed.
    """
    timed = clockings.withColumn("_at", F.col(moment).cast("timestamp")).where(F.col(employee).isNotNull())
    totals = (
        timed.withWatermark("_at", delay)
        .groupBy(F.window("_at", "1 day").alias("_day"), F.col(employee).alias("employee_sesame_id"))
        .agg(F.coalesce(F.sum(seconds), F.lit(0)).alias("worked_time"))
    )
    return totals.select("employee_sesame_id", F.to_date("_day.start").alias("date"), "worked_time")


def correct_late_days(
    clockings: DataFrame, moment: str, employee: str, seconds: str, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Bring rows that the totals' stream has dropped as late into the totals.

    To be run after ``start_daily_totals`` has ended, over the same source. Every
    row is stored by batch and day. Rows whose day was closed when they came, by
    the moments of the batches before, also go to ``<path>.late``. The totals of
    each employee and day that has a row in a day closed by now are summed up
    anew from the stored rows of those days alone, and merged. Days that are
    still open are left to the totals' stream, whose state has all their rows.
    A batch that comes again writes the same folders and the same totals.
    """
    keys = ["employee_sesame_id", "date"]
    rows = clockings.select(
        F.col(employee).alias("employee_sesame_id"),
        F.to_date(F.col(moment).cast("timestamp")).alias("date"),
        F.col(moment).cast("timestamp").alias("at"),
        F.col(seconds).cast("bigint").alias("seconds"),
    ).where("employee_sesame_id is not null and date is not null")

    def load(batch: DataFrame, number: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        latest = F.max("at").alias("latest")
        batch.write.mode("overwrite").partitionBy("date").parquet(f"{path}.rows/batch={number}")
        stored = spark.read.schema(schema).parquet(f"{path}.rows").drop("batch")
        came = spark.read.schema(schema).parquet(f"{path}.rows/batch={number}")
        # One row per batch.
        came.agg(latest).coalesce(1).write.mode("overwrite").parquet(f"{path}.marks/batch={number}")
        marks = spark.read.schema("latest timestamp, batch int").parquet(f"{path}.marks")
        before = F.max(F.when(F.col("batch") < number, F.col("latest")))
        closed = marks.select(*[F.to_date(m - F.expr(f"interval {delay}")) for m in (before, F.max("latest"))]).first()

        late = came.where(F.col("date") < closed[0]) if closed[0] else came.limit(0)
        late.write.mode("overwrite").parquet(f"{path}.late/batch={number}")
        if closed[1] is None:
            return
        touched = came.where(F.col("date") < closed[1]).select(*keys).distinct()
        # One value per day that the batch has rows of.
        days = [row[0] for row in touched.select("date").distinct().collect()]
        anew = stored.where(F.col("date").isin(days)).join(touched, keys, "left_semi")
        totals = anew.groupBy(*keys).agg(F.coalesce(F.sum("seconds"), F.lit(0)).alias("worked_time"))
        merge_into(spark, path, totals, keys, ["date"], rows_move=False)

    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came after their day was closed, with the batch they came in."""
    schema = "employee_sesame_id string, date date, at timestamp, seconds bigint, batch int"
    return spark.read.schema(schema).parquet(f"{path}.late")


def start_daily_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Upsert the changed totals of every batch into the table."""

    def load(batch: DataFrame, _: int) -> None:
        merge_into(batch.sparkSession, path, batch, ["employee_sesame_id", "date"], ["date"])

    writer = totals.writeStream.outputMode("update").foreachBatch(load)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
