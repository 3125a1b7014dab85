"""Star joins, latest records, lookups and daily totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, moment_text, query
from jornada.functions import duration_hours
from jornada.operators.daily import daily_worked_hours, worked_hours_with_checks
from jornada.operators.latest import last_id_per_key, latest_per_key, latest_values
from jornada.operators.lookup import lookup_contains
from jornada.plans.marts import latest_departments

_ENTRY_KEYS = "e.time_entry_sesame_id, e.employee_sesame_id, e.project_sesame_id"


def _entry_keys(t: Tables) -> DataFrame:
    return roles.entries(t).select("time_entry_sesame_id", "employee_sesame_id", "project_sesame_id")


@query(
    "join_left_project",
    f"""select {_ENTRY_KEYS}, p.project_name, p.customer_sesame_id, p.customer_name
        from ({roles.ENTRIES}) as e left join ({roles.PROJECTS}) as p using (project_sesame_id)""",
)
def join_left_project(t: Tables) -> DataFrame:
    return _entry_keys(t).join(roles.projects(t).drop("project_status"), "project_sesame_id", "left")


@query(
    "join_left_employee",
    f"""select {_ENTRY_KEYS}, p.empleado_sesame_id, p.nombre, p.apellidos, p.costo_hora_empresa
        from ({roles.ENTRIES}) as e left join ({roles.EMPLOYEES}) as p on employee_sesame_id = empleado_sesame_id""",
)
def join_left_employee(t: Tables) -> DataFrame:
    same = F.col("employee_sesame_id") == F.col("empleado_sesame_id")
    return _entry_keys(t).join(roles.employees(t), same, "left")


@query(
    "join_inner_employee",
    f"""select {_ENTRY_KEYS}, p.nombre, p.apellidos
        from ({roles.ENTRIES}) as e join ({roles.EMPLOYEES}) as p on employee_sesame_id = empleado_sesame_id""",
)
def join_inner_employee(t: Tables) -> DataFrame:
    people = roles.employees(t).select("empleado_sesame_id", "nombre", "apellidos")
    joined = _entry_keys(t).join(people, F.col("employee_sesame_id") == F.col("empleado_sesame_id"))
    return joined.drop("empleado_sesame_id")


@query(
    "join_latest_assignment",
    f"""select {_ENTRY_KEYS}, d.department_name
        from ({roles.ENTRIES}) as e
        left join ({roles.LATEST_ASSIGNMENTS}) as a on a.employee_sesame_id = e.employee_sesame_id
        left join ({roles.DEPARTMENTS}) as d on d.department_sesame_id = a.department_sesame_id""",
)
def join_latest_assignment(t: Tables) -> DataFrame:
    names = latest_departments(roles.assignments(t), roles.departments(t))
    return _entry_keys(t).join(names, "employee_sesame_id", "left")


@query(
    "latest_per_key",
    f"""select o_custkey, o_orderkey, {moment_text("o_orderdate")} as o_orderdate, o_orderpriority
        from (select *, row_number() over (partition by o_custkey
                  order by o_orderdate desc nulls last, o_orderkey desc) as n from orders) as o where n = 1""",
)
def latest_orders(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return latest_per_key(rows, ["o_custkey"], "o_orderdate", "o_orderkey")


@query(
    "latest_max_by",
    """select o_custkey, arg_max(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) as o_orderkey,
              arg_max(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) as o_orderpriority
       from orders group by o_custkey""",
)
def latest_max_by(t: Tables) -> DataFrame:
    return latest_values(t.orders, ["o_custkey"], ["o_orderkey", "o_orderpriority"], "o_orderdate", "o_orderkey")


@query(
    "last_id_per_key",
    f"""select nid, max(c_custkey) as empleado_id from (select {roles.NATIONAL_ID} as nid, c_custkey from customer)
        as c where nid is not null group by nid""",
)
def last_id(t: Tables) -> DataFrame:
    people = t.customer.select(roles.national_id().alias("nid"), F.col("c_custkey").alias("empleado_id"))
    return last_id_per_key(people, "nid", "empleado_id")


_LOOKUP_ORACLE = """
    with clients as (
        select c_custkey as id, upper(c_mktsegment || ' / ' || n_name || ' sl') as client
        from customer join nation on c_nationkey = n_nationkey),
    found as (
        select client, min(n_nationkey) as company_id
        from (select distinct client from clients) as c join nation on contains(lower(client), lower(n_name))
        group by client)
    select id, client, company_id from clients left join found using (client)"""


def _clients(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    client = F.upper(F.concat("c_mktsegment", F.lit(" / "), "n_name", F.lit(" sl")))
    return joined.select(F.col("c_custkey").alias("id"), client.alias("client"))


def _company_of_client(t: Tables, **how) -> DataFrame:
    # NATION_1 is contained in NATION_10 .. NATION_19: the order decides.
    return lookup_contains(
        _clients(t), "client", roles.companies(t), "nombre", "empresa_id", "empresa_id", "company_id", **how
    )


@query("lookup_contains", _LOOKUP_ORACLE)
def lookup_company(t: Tables) -> DataFrame:
    return _company_of_client(t)


@query("lookup_contains_substrings", _LOOKUP_ORACLE)
def lookup_company_by_substrings(t: Tables) -> DataFrame:
    """The way a dimension too large for a chain of tests is looked up."""
    return _company_of_client(t, inline_rows=0)


_LOOKUP_NULLS = """select p_partkey as id, p_name,
              case when contains(lower(p_name), 'ring') then 10 when contains(lower(p_name), 'bolt') then 20
                   when contains(lower(p_name), 'o') then 40 else 35 end as department_id
       from part"""


def _department_with_nulls(t: Tables, **how) -> DataFrame:
    """A dimension with rows that lack text, id or rank."""
    dim = t.spark.sql(
        """select * from values (null, 'o', 1), (40, 'O ', null), (50, 'o', null), (20, 'bolt', 2), (10, 'ring', 1),
           (60, null, 0) as dim(id, name, place)"""
    )
    parts = t.part.select(F.col("p_partkey").alias("id"), "p_name")
    return lookup_contains(parts, "p_name", dim, "name", "id", "place", "department_id", default=35, **how)


@query("lookup_contains_nulls", _LOOKUP_NULLS)
def lookup_nulls(t: Tables) -> DataFrame:
    return _department_with_nulls(t)


@query("lookup_contains_nulls_substrings", _LOOKUP_NULLS)
def lookup_nulls_by_substrings(t: Tables) -> DataFrame:
    return _department_with_nulls(t, inline_rows=0)


@query(
    "lookup_contains_default",
    """select p_partkey as id, p_name,
              case when p_name is null then 35
                   when contains(lower(p_name), 'ring') then 10 when contains(lower(p_name), 'bolt') then 20
                   when contains(lower(p_name), 'widget') then 30 when contains(lower(p_name), 'in') then 40
                   when contains(lower(p_name), 'anvil') then 50
                   else 35 end as department_id
       from part""",
)
def lookup_department(t: Tables) -> DataFrame:
    dim = t.spark.createDataFrame(
        [(10, "Ring ", 1), (20, "bolt", 2), (30, "WIDGET\t", 3), (40, "in", 4), (60, None, 0)],
        "id int, name string, place int",
    )
    parts = t.part.select(F.col("p_partkey").alias("id"), "p_name")
    return lookup_contains(
        parts, "p_name", dim, "name", "id", "place", "department_id", default=35, aliases=[("anvil", 50)]
    )


@query(
    "daily_worked_hours",
    f"""select "employeeId", {day_text('"date"')} as "date", "secondsWorked", "secondsToWork", "secondsBalance"
        from ({roles.DAILY}) as d""",
)
def daily(t: Tables) -> DataFrame:
    return daily_worked_hours(roles.clock_records(t))


@query(
    "worked_hours_with_checks",
    f"""select "employeeId", {day_text('"date"')} as "date", check_id, check_line,
               d."secondsWorked", d."secondsToWork", d."secondsBalance"
        from ({roles.CLOCK_RECORDS}) as c join ({roles.DAILY}) as d using ("employeeId", "date")""",
)
def daily_with_checks(t: Tables) -> DataFrame:
    return worked_hours_with_checks(roles.clock_records(t), ["check_id", "check_line"])


@query(
    "duration_hours",
    f"""select time_entry_sesame_id as id,
               (epoch_us(time_entry_out) - epoch_us(time_entry_in)) / 3.6e9 as hours
        from ({roles.ENTRIES}) as e""",
)
def hours_of_entries(t: Tables) -> DataFrame:
    hours = duration_hours(F.col("time_entry_in"), F.col("time_entry_out"))
    return roles.entries(t).select(F.col("time_entry_sesame_id").alias("id"), hours.alias("hours"))
