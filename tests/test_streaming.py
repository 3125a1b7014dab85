from pathlib import Path

from conftest import rows
from landing_zone import time_entry, write_pages
from pyspark.sql import functions as F

from jornada.operators import flatten
from jornada.operators.daily import daily_worked_hours
from jornada.plans import facts
from jornada.session import checkpoint_folder
from jornada.sources.landing import stream_landing
from jornada.sources.tables import read_table
from jornada.streaming.incremental import daily_seconds_stream, start_daily_totals, start_incremental_load


def entries_of(batch):
    return facts.time_entries(flatten.flatten_time_entries(batch))


def load(spark, root, table, checkpoint):
    records = stream_landing(spark, root, "time_entries", max_files=1)
    start_incremental_load(
        records,
        entries_of,
        table,
        ["time_entry_sesame_id"],
        checkpoint,
        order=("time_entry_in", "comment"),
    ).awaitTermination()
    return rows(read_table(spark, table).select("time_entry_sesame_id", "employee_sesame_id", "comment"))


def test_new_files_are_upserted_and_replays_change_nothing(spark, tmp_path):
    root, table = tmp_path / "landing", f"{tmp_path}/table"
    start, end = "2024-01-10T08:00:00Z", "2024-01-10T09:00:00Z"
    first = [time_entry("t1", "e1", start, end, comment="a"), time_entry("t1", "e1", start, end, comment="b")]
    write_pages(root, "time_entries", "north", first, name="one")
    write_pages(root, "time_entries", "south", [time_entry("t2", "e2", start, end, comment="c")], name="two")
    assert load(spark, str(root), table, f"{tmp_path}/c1") == [("t1", "e1", "b"), ("t2", "e2", "c")]

    write_pages(root, "time_entries", "north", [time_entry("t1", "e1", start, end, comment="new")], name="three")
    after = [("t1", "e1", "new"), ("t2", "e2", "c")]
    assert load(spark, str(root), table, f"{tmp_path}/c1") == after
    assert load(spark, str(root), table, f"{tmp_path}/c1") == after


def test_a_late_file_with_an_older_version_changes_nothing(spark, tmp_path):
    root, table = tmp_path / "landing", f"{tmp_path}/table"
    old, new = "2024-01-10T08:00:00Z", "2024-01-11T08:00:00Z"
    write_pages(root, "time_entries", "north", [time_entry("t1", "e1", new, new, comment="new")], name="one")
    assert load(spark, str(root), table, f"{tmp_path}/c1") == [("t1", "e1", "new")]
    late = [time_entry("t1", "e1", old, old, comment="old"), time_entry("t2", "e2", old, old, comment="c")]
    write_pages(root, "time_entries", "north", late, name="two")
    assert load(spark, str(root), table, f"{tmp_path}/c1") == [("t1", "e1", "new"), ("t2", "e2", "c")]


def test_stream_totals_equal_batch_totals(spark, tmp_path):
    data = spark.range(3000).select(
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 131 % 400000)").alias("at"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("e"), (F.col("id") % 7).cast("string"))).alias("employeeId"),
        (F.col("id") % 60).alias("secondsWorked"),
    )
    source = f"{tmp_path}/in"
    data.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(source)
    totals = daily_seconds_stream(stream, "at", "employeeId", "secondsWorked", "10 days")
    start_daily_totals(totals, f"{tmp_path}/table", f"{tmp_path}/checkpoint").awaitTermination()
    batch = daily_worked_hours(data.withColumn("date", F.to_date("at")), seconds=["secondsWorked"])
    got = read_table(spark, f"{tmp_path}/table").select("employee_sesame_id", "date", "worked_time")
    assert rows(got) == rows(batch)


def test_queries_read_a_table_of_several_files(spark, tmp_path):
    from jornada.catalogue import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("incremental_load", "stream_daily_hours"):
        assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_large_deliveries_make_no_more_batches(spark, tmp_path):
    from jornada.catalogue import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("ts < '2024-01-08'")
    # Rows without a time, a user or a type, and rows that come twice.
    odd = events.limit(20)
    gone = [odd.withColumn(c, F.lit(None).cast(odd.schema[c].dataType)) for c in ("ts", "user_id", "event_type")]
    data = gone[0].union(gone[1]).union(gone[2]).union(odd).union(events)
    data.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    streams = Path(checkpoint_folder(spark)) / "streams"
    before = set(streams.glob("*"))
    got = rows(QUERIES["stream_late_rows"](spark, str(tmp_path)))

    (folder,) = set(streams.glob("*")) - before
    assert len(list((folder / "in").glob("*.parquet"))) == 15
    batches = [len([f for f in (folder / c / "offsets").iterdir() if f.name.isdigit()]) for c in ("checkpoint", "late-checkpoint")]
    # The totals may have a last batch without rows that only closes days.
    assert batches[0] in (5, 6) and batches[1] == 5
    known = spark.read.parquet(f"{tmp_path}/events.parquet").where("user_id is not null and ts is not null")
    seconds = F.sum(F.round(F.col("value") * 60).cast("bigint"))
    totals = known.groupBy(F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).agg(seconds)
    assert got == rows(totals)
