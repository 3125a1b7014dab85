"""The incremental loads, run over a table as a stream of files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, moment_text, query
from jornada.session import checkpoint_folder
from jornada.sources.files import children, is_folder
from jornada.sources.tables import read_table
from jornada.streaming.incremental import (
    correct_late_days,
    daily_seconds_stream,
    start_daily_totals,
    start_incremental_load,
)

# Fixed value: in how many deliveries the events come to stream_late_rows.
DELIVERIES = 5


def _event_stream(t: Tables) -> DataFrame:
    """The table as a stream of its files: a folder of part files, or one file."""
    reader = t.spark.readStream.schema(t.events.schema)
    path = f"{t.folder}/events.parquet"
    if is_folder(t.spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(t.folder)


def _work_folder(t: Tables) -> str:
    return f"{checkpoint_folder(t.spark)}/streams/{uuid.uuid4().hex}"


@query(
    "incremental_load",
    f"""select cast(event_id as varchar) as time_entry_sesame_id, {moment_text("ts")} as time_entry_in,
               event_type as tags, cast(user_id as varchar) as employee_sesame_id from events""",
)
def incremental_load(t: Tables) -> DataFrame:
    def rows(batch: DataFrame) -> DataFrame:
        return batch.select(
            roles.text("event_id").alias("time_entry_sesame_id"),
            F.col("ts").alias("time_entry_in"),
            F.col("event_type").alias("tags"),
            roles.text("user_id").alias("employee_sesame_id"),
        )

    folder = _work_folder(t)
    table = f"{folder}/table"
    start_incremental_load(
        _event_stream(t), rows, table, ["time_entry_sesame_id"], f"{folder}/checkpoint"
    ).awaitTermination()
    return read_table(t.spark, table)


@query(
    "stream_daily_hours",
    f"""select cast(user_id as varchar) as employee_sesame_id, {day_text("ts")} as "date",
               cast(sum(cast(round(value * 60) as bigint)) as bigint) as worked_time
        from events group by 1, 2""",
)
def stream_daily_hours(t: Tables) -> DataFrame:
    clockings = _event_stream(t).select(
        "ts",
        roles.text("user_id").alias("employee"),
        F.round(F.col("value") * 60).cast("bigint").alias("seconds"),
    )
    folder = _work_folder(t)
    table = f"{folder}/table"
    totals = daily_seconds_stream(clockings, "ts", "employee", "seconds", delay="2 days")
    start_daily_totals(totals, table, f"{folder}/checkpoint").awaitTermination()
    return read_table(t.spark, table)


@query(
    "stream_late_rows",
    f"""select cast(user_id as varchar) as employee_sesame_id, {day_text("ts")} as "date",
               cast(sum(cast(round(value * 60) as bigint)) as bigint) as worked_time
        from events group by 1, 2""",
)
def stream_late_rows(t: Tables) -> DataFrame:
    """The events come in five deliveries, and most days are closed before their last rows come.

    A large delivery has many files. A batch takes a fifth of all files, so there
    are five batches at any size.
    """
    folder = _work_folder(t)
    for number in range(DELIVERIES):
        part = t.events.where(F.abs(F.xxhash64("event_type", "user_id")) % DELIVERIES == number)
        part.write.mode("append").parquet(f"{folder}/in")
    files = [name for name in children(t.spark, f"{folder}/in") if name.endswith(".parquet")]
    a_fifth = -(-len(files) // DELIVERIES)
    reader = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", a_fifth)
    clockings = reader.parquet(f"{folder}/in").select(
        "ts",
        roles.text("user_id").alias("employee"),
        F.round(F.col("value") * 60).cast("bigint").alias("seconds"),
    )
    table = f"{folder}/table"
    totals = daily_seconds_stream(clockings, "ts", "employee", "seconds", delay="2 days")
    start_daily_totals(totals, table, f"{folder}/checkpoint").awaitTermination()
    late = correct_late_days(clockings, "ts", "employee", "seconds", "2 days", table, f"{folder}/late-checkpoint")
    late.awaitTermination()
    return read_table(t.spark, table)
