"""Listing queries: filters, order and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, moment_text, query
from jornada.operators import listing
from jornada.operators.daily import daily_worked_hours

_PEOPLE = """
    select c_custkey as id, c_name as name, cast(c_nationkey as varchar) as code, c_mktsegment as nid,
           lower(c_name) || '@example.org' as email,
           case when c_acctbal >= 0 then 'active' else 'inactive' end as status, c_acctbal as cost
    from customer"""


def _people(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        roles.text("c_nationkey").alias("code"),
        F.col("c_mktsegment").alias("nid"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.when(F.col("c_acctbal") >= 0, "active").otherwise("inactive").alias("status"),
        F.col("c_acctbal").alias("cost"),
    )


@query("listing_filter", f"select * from ({_PEOPLE}) as p where code = '7' and status = 'active' and nid = 'BUILDING'")
def listing_filter(t: Tables) -> DataFrame:
    return listing.list_entity(_people(t), "employees", code="7", dni="BUILDING", status="active", email=None)


@query("listing_in", f"select id, name from ({_PEOPLE}) as p where code in ('3', '11') or nid in ('3', 'MACHINERY')")
def listing_in(t: Tables) -> DataFrame:
    people = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.array(roles.text("c_nationkey"), F.col("c_mktsegment")).alias("department_ids"),
    )
    chosen = listing.list_entity(people, "employees", department_ids=["3", "11", "MACHINERY"])
    return chosen.drop("department_ids")


@query(
    "listing_in_large",
    """select o_orderkey, o_custkey, o_totalprice from orders
       where o_custkey in (select c_custkey from customer where c_acctbal < 5000)""",
)
def listing_in_large(t: Tables) -> DataFrame:
    """A value list too long for the plan, given as a table."""
    chosen = t.customer.where("c_acctbal < 5000").select("c_custkey")
    return listing.one_of(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", chosen)


@query(
    "listing_order",
    f"""select id, name, code, cost, cast(row_number() over (order by code asc, cost desc, id asc) as int) as place
        from ({_PEOPLE}) as p order by place limit 500""",
)
def listing_order(t: Tables) -> DataFrame:
    page = listing.page_of(_people(t), "code asc, cost desc", limit=500, tie_break=["id"])
    # The page is the feature; its 500 rows are numbered to show their order.
    return _numbered(page.select("id", "name", "code", "cost"), ["code", F.desc("cost"), "id"])


def _numbered(page: DataFrame, order: list) -> DataFrame:
    return page.withColumn("place", F.row_number().over(Window.orderBy(*order)))


@query(
    "listing_page",
    f"select * from ({_PEOPLE}) as p where status = 'active' order by cost desc, name asc, id asc limit 100 offset 200",
)
def listing_page(t: Tables) -> DataFrame:
    return listing.list_entity(
        _people(t), "employees", status="active", order_by="cost desc, name asc", limit=100, page=3
    )


@query("listing_in_list", "select o_orderkey as id, o_custkey as customer from orders where o_custkey in (3, 5, 8, 13)")
def listing_in_list(t: Tables) -> DataFrame:
    """Values given as text, as a request gives them."""
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))
    return listing.one_of(orders, "customer", ["3", "5", "8", "13", "none", None])


@query("listing_in_long_list", "select o_orderkey as id, o_custkey as customer from orders where o_custkey between 1 and 1500")
def listing_in_long_list(t: Tables) -> DataFrame:
    """More values than are written into a plan."""
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))
    return listing.one_of(orders, "customer", [*map(str, range(1, 1501)), "none", None])


@query(
    "listing_worked_hours",
    f"""select "employeeId", {day_text('"date"')} as "date", "secondsWorked", "secondsToWork", "secondsBalance"
        from ({roles.DAILY}) as d
        where "employeeId" in ('3', '5', '8') and "date" between date '1996-01-01' and date '1997-12-31'""",
)
def listing_worked_hours(t: Tables) -> DataFrame:
    return listing.list_entity(
        daily_worked_hours(roles.clock_records(t)),
        "worked_hours",
        employee_ids=["3", "5", "8"],
        from_date="1996-01-01",
        to_date="1997-12-31",
    )


_WORK_ENTRIES = """
    select event_id as id, user_id as employee_id, ts as work_entry_in, ts + interval 1 day as updated_at,
           case when event_type = 'error' then ts + interval 2 day end as deleted_at
    from events"""


def _work_entries(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("employee_id"),
        F.col("ts").alias("work_entry_in"),
        F.expr("ts + interval 1 day").alias("updated_at"),
        F.when(F.col("event_type") == "error", F.expr("ts + interval 2 days")).alias("deleted_at"),
    )


@query(
    "changed_since",
    f"""select id, employee_id, {moment_text("updated_at")} as updated_at from ({_WORK_ENTRIES}) as w
        where updated_at >= timestamp '2024-01-08 12:00:00' and updated_at <= timestamp '2024-01-19 18:30:00'""",
)
def changed_since(t: Tables) -> DataFrame:
    chosen = listing.changed_between(_work_entries(t), "updated_at", "2024-01-08 12:00:00", "2024-01-19 18:30:00")
    return chosen.select("id", "employee_id", "updated_at")


@query(
    "soft_delete_filter",
    f"""select id, 'deleted' as asked from ({_WORK_ENTRIES}) as w where deleted_at is not null
        union all select id, 'not_deleted' from ({_WORK_ENTRIES}) as w where deleted_at is null
        union all select id, 'all' from ({_WORK_ENTRIES}) as w""",
)
def soft_delete_filter(t: Tables) -> DataFrame:
    def asked(option: str) -> DataFrame:
        return listing.soft_deleted(_work_entries(t), option).select("id", F.lit(option).alias("asked"))

    return asked("deleted").union(asked("not_deleted")).union(asked("all"))


@query(
    "listing_work_entries",
    f"""select id, employee_id, {moment_text("work_entry_in")} as work_entry_in from ({_WORK_ENTRIES}) as w
        where employee_id = 7 and cast(work_entry_in as date) between date '2024-01-03' and date '2024-01-25'
        and updated_at >= timestamp '2024-01-06 00:00:00' and deleted_at is null
        order by work_entries_order desc, id limit 20 offset 20""".replace("work_entries_order", "w.work_entry_in"),
)
def listing_work_entries(t: Tables) -> DataFrame:
    page = listing.list_entity(
        _work_entries(t),
        "work_entries",
        employee_id=7,
        from_date="2024-01-03",
        to_date="2024-01-25",
        updated_at_gte="2024-01-06 00:00:00",
        order_by="work_entry_in desc",
        limit=20,
        page=2,
    )
    return page.select("id", "employee_id", "work_entry_in")


@query(
    "entries_by_employee_status",
    """select event_id as id, user_id as employee_id from events
       where user_id in (select c_custkey from customer where c_acctbal >= 0)""",
)
def entries_by_employee_status(t: Tables) -> DataFrame:
    charged = t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("employee_id"))
    return listing.list_entity(charged, "time_entries", employees=_people(t))
