"""The test tables in the roles of the data model, as DataFrames and as SQL.

events = charged time entries, orders = department assignments, customer and
supplier = employees, part = projects, region = departments, nation =
companies, lineitem = clock records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.catalogue.registry import Tables

FROM_DATE, TO_DATE = "2024-01-05", "2024-01-20"


def text(column: str) -> Column:
    return F.col(column).cast("string")


def department_number() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int") - 1


def project_number() -> Column:
    """Entries of high value have numbers that no part has."""
    return F.round(F.col("value") * 100).cast("bigint").cast("string")


PROJECT_NUMBER = "cast(cast(round(value * 100) as bigint) as varchar)"


def entry_end() -> Column:
    seconds = F.round(F.col("value") * 60).cast("bigint")
    return F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


# ---- warehouse tables ----------------------------------------------------


def entries(t: Tables) -> DataFrame:
    return t.events.select(
        text("event_id").alias("time_entry_sesame_id"),
        project_number().alias("project_sesame_id"),
        F.col("ts").alias("time_entry_in"),
        entry_end().alias("time_entry_out"),
        F.col("event_type").alias("tags"),
        F.col("props").alias("comment"),
        text("user_id").alias("employee_sesame_id"),
    )


ENTRIES = f"""
    select cast(event_id as varchar) as time_entry_sesame_id,
           {PROJECT_NUMBER} as project_sesame_id, ts as time_entry_in,
           ts + to_seconds(cast(round(value * 60) as bigint)) as time_entry_out,
           event_type as tags, props as comment, cast(user_id as varchar) as employee_sesame_id
    from events"""


def projects(t: Tables) -> DataFrame:
    return t.part.select(
        text("p_partkey").alias("project_sesame_id"),
        F.col("p_name").alias("project_name"),
        F.col("p_brand").alias("customer_sesame_id"),
        F.concat(F.lit("Client "), "p_brand").alias("customer_name"),
        F.col("p_type").alias("project_status"),
    )


PROJECTS = """
    select cast(p_partkey as varchar) as project_sesame_id, p_name as project_name,
           p_brand as customer_sesame_id, 'Client ' || p_brand as customer_name, p_type as project_status
    from part"""


def employees(t: Tables) -> DataFrame:
    """Only those with a cost that is not negative, so that some entries have no employee."""
    return t.customer.where("c_acctbal >= 0").select(
        text("c_custkey").alias("empleado_sesame_id"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("apellidos"),
        F.col("c_acctbal").alias("costo_hora_empresa"),
    )


EMPLOYEES = """
    select cast(c_custkey as varchar) as empleado_sesame_id, c_name as nombre,
           c_mktsegment as apellidos, c_acctbal as costo_hora_empresa
    from customer where c_acctbal >= 0"""


def assignments(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("department_assignation_sesame_id"),
        text("o_custkey").alias("employee_sesame_id"),
        department_number().cast("string").alias("department_sesame_id"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_orderdate").alias("update_date"),
    )


ASSIGNMENTS = """
    select o_orderkey as department_assignation_sesame_id, cast(o_custkey as varchar) as employee_sesame_id,
           cast(cast(substr(o_orderpriority, 1, 1) as int) - 1 as varchar) as department_sesame_id,
           o_orderdate as creation_date, o_orderdate as update_date
    from orders"""

LATEST_ASSIGNMENTS = f"""
    select employee_sesame_id, department_sesame_id
    from (select *, row_number() over (partition by employee_sesame_id
              order by update_date desc nulls last, department_assignation_sesame_id desc) as n
          from ({ASSIGNMENTS}) as a) as ranked
    where n = 1"""


def departments(t: Tables) -> DataFrame:
    return t.region.select(text("r_regionkey").alias("department_sesame_id"), F.col("r_name").alias("department_name"))


DEPARTMENTS = "select cast(r_regionkey as varchar) as department_sesame_id, r_name as department_name from region"


def clock_records(t: Tables) -> DataFrame:
    return t.lineitem.select(
        text("l_suppkey").alias("employeeId"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_quantity") * 60).cast("bigint").alias("secondsWorked"),
        F.lit(1800).cast("bigint").alias("secondsToWork"),
        ((F.col("l_quantity") - 30) * 60).cast("bigint").alias("secondsBalance"),
        F.col("l_orderkey").alias("check_id"),
        F.col("l_linenumber").alias("check_line"),
        F.col("l_returnflag"),
    )


CLOCK_RECORDS = """
    select cast(l_suppkey as varchar) as "employeeId", cast(l_shipdate as date) as "date",
           cast(l_quantity * 60 as bigint) as "secondsWorked", cast(1800 as bigint) as "secondsToWork",
           cast((l_quantity - 30) * 60 as bigint) as "secondsBalance",
           l_orderkey as check_id, l_linenumber as check_line, l_returnflag
    from lineitem"""

DAILY = f"""
    select "employeeId", "date", cast(sum("secondsWorked") as bigint) as "secondsWorked",
           cast(sum("secondsToWork") as bigint) as "secondsToWork",
           cast(sum("secondsBalance") as bigint) as "secondsBalance"
    from ({CLOCK_RECORDS}) as c group by "employeeId", "date" """


def suppliers_as_employees(t: Tables) -> DataFrame:
    return t.supplier.where("s_acctbal >= 0").select(
        text("s_suppkey").alias("empleado_sesame_id"),
        F.col("s_name").alias("nombre"),
        text("s_nationkey").alias("apellidos"),
    )


SUPPLIERS_AS_EMPLOYEES = """
    select cast(s_suppkey as varchar) as empleado_sesame_id, s_name as nombre,
           cast(s_nationkey as varchar) as apellidos
    from supplier where s_acctbal >= 0"""


# ---- nested landing records ----------------------------------------------


def raw_assignments(t: Tables) -> DataFrame:
    company = F.struct(text("c_nationkey").alias("id"), F.col("c_mktsegment").alias("name"))
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        text("o_orderkey").alias("id"),
        F.struct(text("o_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, company).alias("company")).alias(
            "employee"
        ),
        F.struct(
            department_number().cast("string").alias("id"),
            F.concat(F.lit("Area "), F.substring("o_orderpriority", 3, 20)).alias("name"),
        ).alias("department"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("createdAt"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'10:30:00'+02:00'").alias("updatedAt"),
    )


RAW_ASSIGNMENTS = """
    select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as employee_id,
           cast(cast(substr(o_orderpriority, 1, 1) as int) - 1 as varchar) as department_id,
           'Area ' || substr(o_orderpriority, 3, 20) as department_name,
           case when c_acctbal >= 0 then cast(c_nationkey as varchar) end as company_id,
           case when c_acctbal >= 0 then c_mktsegment end as company_name,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+02:00') as created_at,
           strftime(o_orderdate, '%Y-%m-%dT10:30:00+02:00') as updated_at
    from orders left join customer on o_custkey = c_custkey"""


def raw_projects(t: Tables) -> DataFrame:
    client = F.struct(F.col("p_brand").alias("id"), F.concat(F.lit("Client "), "p_brand").alias("customerName"))
    return t.part.select(
        text("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_type") != "PROMO", client).alias("customer"),
        F.col("p_retailprice").alias("price"),
        F.struct(F.lower("p_type").alias("value")).alias("projectStatus"),
        F.lit(None).cast("string").alias("externalProjectId"),
    )


def raw_time_entries(t: Tables) -> DataFrame:
    is_error = F.col("event_type") == "error"
    named = F.array(F.struct(F.col("event_type").alias("name")), F.struct(F.col("props").alias("name")))
    none = F.array().cast("array<struct<name:string>>")
    return t.events.select(
        text("event_id").alias("id"),
        F.struct(text("user_id").alias("id")).alias("employee"),
        F.when(~is_error, F.struct(project_number().alias("id"))).alias("project"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("date")).alias("timeEntryIn"),
        F.struct(F.date_format(entry_end(), "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("date")).alias("timeEntryOut"),
        F.struct(F.when(is_error | (F.col("value") < 5), none).otherwise(named).alias("data")).alias("tags"),
        F.when(F.col("event_type") != "view", F.repeat("props", 25)).alias("comment"),
    )


def _utc_second(moment: str) -> str:
    return f"date_trunc('second', {moment}) - interval 1 hour"


RAW_TIME_ENTRIES = f"""
    select cast(event_id as varchar) as id, cast(user_id as varchar) as employee_id,
           case when event_type = 'error' then '' else {PROJECT_NUMBER} end as project_id,
           {_utc_second("ts")} as time_in,
           {_utc_second("(ts + to_seconds(cast(round(value * 60) as bigint)))")} as time_out,
           case when event_type = 'error' or value < 5 then '' else event_type || ',' || props end as tags,
           case when event_type <> 'view' then repeat(props, 25) end as comment
    from events"""


def raw_employees(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    nation = t.nation.select("n_nationkey", "n_name")

    def field(slug: str, value: Column) -> Column:
        return F.struct(F.lit(slug).alias("slug"), value.cast("string").alias("value"))

    filled = F.array(
        field("cf_rea", segment),
        field("cf_precioh_empresa", F.replace(text("c_acctbal"), F.lit("."), F.lit(","))),
        field("cf_fecha_de_alta", F.concat(F.lit("03/"), F.lpad(text("c_nationkey"), 2, "0"), F.lit("/2020"))),
        field("cf_rea", F.lit("second value")),
        field("cf_fecha_de_baja", F.lit("2023-11-30")),
        field("ccf_studies", F.when(segment == "BUILDING", F.lit("degree"))),
        field("cf_telefono_corto", F.substring("c_name", 10, 4)),
    )
    empty = F.array().cast("array<struct<slug:string,value:string>>")
    nothing = {
        name: F.lit(None).cast("string").alias(name)
        for name in (
            "workStatus imageProfileURL code pin contractId ssn accountNumber city province maritalStatus "
            "salaryRange professionalCategoryCode professionalCategoryDescription bic jobChargeId jobChargeName"
        ).split()
    }
    joined = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        text("c_custkey").alias("id"),
        F.col("c_name").alias("firstName"),
        segment.alias("lastName"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.substring("c_name", 10, 9).alias("phone"),
        F.struct(
            F.concat(F.lit("Company "), F.lower("n_name"), F.lit(" \t")).alias("id"),
            F.concat(F.lit("Grupo "), "n_name", F.lit(" SL ")).alias("name"),
        ).alias("company"),
        F.when(segment != "MACHINERY", F.lit("x")).alias("gender"),
        national_id().alias("nid"),
        F.when(segment == "BUILDING", F.lit("passport")).alias("identityNumberType"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("pricePerHour"),
        F.when(segment != "FURNITURE", F.lit("1990-05-17")).alias("dateOfBirth"),
        F.when(segment == "AUTOMOBILE", empty).otherwise(filled).alias("customFields"),
        F.when(F.col("c_acctbal") >= 0, F.lit("active")).otherwise(F.lit("inactive")).alias("status"),
        F.when(segment != "BUILDING", F.col("c_nationkey")).alias("children"),
        F.when(segment == "BUILDING", F.lit(33.5)).alias("disability"),
        F.col("c_name").alias("address"),
        F.substring("c_name", 10, 5).alias("postalCode"),
        F.col("n_name").alias("country"),
        F.col("n_name").alias("nationality"),
        segment.alias("studyLevel"),
        *nothing.values(),
    )


def national_id() -> Column:
    """Shared by several employees, null for one segment."""
    parts = F.concat_ws("-", "c_mktsegment", text("c_nationkey"), F.floor(F.col("c_acctbal") / 500).cast("string"))
    return F.when(F.col("c_mktsegment") != "HOUSEHOLD", parts)


NATIONAL_ID = """case when c_mktsegment <> 'HOUSEHOLD' then
    c_mktsegment || '-' || c_nationkey || '-' || cast(floor(c_acctbal / 500) as bigint) end"""


def companies(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("empresa_id"),
        F.col("n_name").alias("empresa_sesame_id"),
        F.concat("n_name", F.lit(" \t")).alias("nombre"),
    )



def legacy_departments(t: Tables) -> DataFrame:
    """Department names as they occur in the assignments; one name has no department."""
    return t.region.select(
        F.col("r_regionkey").alias("departamento_id"),
        F.element_at(
            F.array(*[F.lit(n) for n in ("URGENT", "HIGH ", "Medium", "NOT", "no such area")]), F.col("r_regionkey") + 1
        ).alias("nombre"),
    )
