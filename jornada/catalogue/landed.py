"""Scans of landed files: tenants and days of the events, written as pages by tenant and day and read as extracts are."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, moment_text, query
from jornada.operators import merge
from jornada.session import checkpoint_folder
from jornada.sources.landing import read_landing, union_tenants

_TENANTS = 5
# Every fourth day is not landed.
_LANDED = "day(ts) % 4 <> 0"


def _landing(t: Tables) -> str:
    """A folder of time entries, a file or more per tenant and day, each page with one record."""
    event = t.events
    record = F.struct(
        roles.text("event_id").alias("id"),
        F.struct(roles.text("user_id").alias("id")).alias("employee"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date")).alias("timeEntryIn"),
        F.col("event_type").alias("comment"),
    )
    pages = event.where(_LANDED).select(
        F.array(record).alias("data"),
        F.concat(F.lit("t"), F.col("user_id") % _TENANTS).alias("tenant"),
        F.to_date("ts").alias("date"),
    )
    root = f"{checkpoint_folder(t.spark)}/loads/{uuid.uuid4().hex}"
    # A hot tenant's day is split over several files.
    pages.hint("rebalance", "tenant", "date").write.partitionBy("tenant", "date").json(f"{root}/time_entries")
    return root


@query(
    "landing_tenants_days",
    f"""select 't' || (user_id % {_TENANTS}) as tenant, cast(event_id as varchar) as id, cast(user_id as varchar) as employee,
               event_type as comment, {moment_text("date_trunc('second', ts)")} as start
        from events where {_LANDED} and user_id % {_TENANTS} in (1, 3) and cast(ts as date) between '2024-01-07' and '2024-01-19'""",
)
def landing_tenants_days(t: Tables) -> DataFrame:
    """Two tenants over two weeks of which some days have no files, and a tenant that was never landed."""
    raw = read_landing(t.spark, _landing(t), "time_entries", ["t1", "t3", "t9"], "2024-01-07", "2024-01-19")
    start = F.to_timestamp("timeEntryIn.date").alias("start")
    return raw.select("tenant", "id", F.col("employee.id").alias("employee"), "comment", start)


@query(
    "landing_days_counted",
    f"""select 't' || (user_id % {_TENANTS}) as tenant, count(*) as entries, count(distinct cast(ts as date)) as days
        from events where {_LANDED} group by 1""",
)
def landing_days_counted(t: Tables) -> DataFrame:
    """What each tenant landed, put together from one read per tenant; days without files and one empty read add nothing."""
    root = _landing(t)
    tenants = [f"t{i}" for i in range(_TENANTS)]
    frames = [read_landing(t.spark, root, "time_entries", [tenant]) for tenant in tenants]
    frames.append(read_landing(t.spark, root, "time_entries", from_date="1990-01-01", to_date="1990-12-31"))
    every = union_tenants(*frames)
    return every.groupBy("tenant").agg(F.count("*").alias("entries"), F.countDistinct("date").alias("days"))


@query(
    "duplicate_keys",
    """select l_partkey, l_suppkey, count(*) as "rows" from lineitem
       where l_quantity > 10 group by l_partkey, l_suppkey having count(*) > 1""",
)
def duplicate_keys(t: Tables) -> DataFrame:
    """Keys that a merge refuses, with how often each occurs."""
    return merge.duplicate_keys(t.lineitem.where("l_quantity > 10"), ["l_partkey", "l_suppkey"])
