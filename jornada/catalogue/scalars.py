"""Cleaning rules, dates and null handling over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, moment_text, query
from jornada.functions import (
    blank_if_null,
    day_first_date,
    decimal_comma,
    first_characters,
    hour_minute,
    right_trim,
    seconds_to_hours,
    to_utc,
    zero_if_null,
)
from jornada.operators.quality import drop_nulls, fill_nulls


@query("truncate_text", "select doc_id, substr(text, 1, 200) as comment from documents")
def truncate_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", first_characters(F.col("text")).alias("comment"))


@query(
    "rtrim_ws",
    r"""select doc_id, cast(length(regexp_replace(text, '\s+$', '')) as int) as n_chars,
               md5(regexp_replace(text, '\s+$', '')) as digest
        from (select doc_id, text || chr(9) || ' ' || chr(10) || '  ' as text from documents) as d""",
)
def rtrim_ws(t: Tables) -> DataFrame:
    trimmed = right_trim(F.concat("text", F.lit("\t \n  ")))
    return t.documents.select("doc_id", F.length(trimmed).alias("n_chars"), F.md5(trimmed).alias("digest"))


@query(
    "decimal_comma",
    """select c_custkey as id, case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then null
              else c_acctbal end as cost from customer""",
)
def decimal_comma_costs(t: Tables) -> DataFrame:
    segment, balance = F.col("c_mktsegment"), roles.text("c_acctbal")
    written = (
        F.when(segment == "BUILDING", None)
        .when(segment == "MACHINERY", "n/a")
        .when(segment == "FURNITURE", balance)
        .otherwise(F.replace(balance, F.lit("."), F.lit(",")))
    )
    return t.customer.select(F.col("c_custkey").alias("id"), decimal_comma(written).alias("cost"))


@query(
    "parse_dayfirst",
    f"""select o_orderkey as id, case o_orderpriority when '1-URGENT' then null when '2-HIGH' then null
               else {day_text("o_orderdate")} end as day from orders""",
)
def parse_dayfirst(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    written = (
        F.when(priority == "1-URGENT", None)
        .when(priority == "2-HIGH", "soon")
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(priority == "5-LOW", F.date_format("o_orderdate", "d/M/yyyy"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    return t.orders.select(F.col("o_orderkey").alias("id"), day_first_date(written).alias("day"))


@query("parse_dayfirst_shapes", f"select o_orderkey as id, {day_text('o_orderdate')} as day from orders")
def parse_dayfirst_shapes(t: Tables) -> DataFrame:
    """Every accepted way to write a date, by turns."""
    shapes = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss+02:00", "d.M.yyyy", "dd/MM/yy", "  dd/MM/yyyy ", "d-M-yyyy",
              "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss"]
    turn = F.col("o_orderkey") % (len(shapes) + 1)
    written = F.date_format("o_orderdate", "dd/MM/yyyy")
    for i, shape in enumerate(shapes):
        quoted = shape.replace("+02:00", "'+02:00'")
        # Two-digit years are those of this century.
        usable = (turn == i) & ((F.year("o_orderdate") >= 2000) if shape == "dd/MM/yy" else F.lit(True))
        written = F.when(usable, F.date_format("o_orderdate", quoted)).otherwise(written)
    return t.orders.select(F.col("o_orderkey").alias("id"), day_first_date(written).alias("day"))


_SHIFT = "case event_type when 'click' then interval 1 hour when 'view' then interval (-5) hour else interval 0 hour end"


@query(
    "parse_utc",
    f"""select event_id as id,
               case when event_type <> 'error' then {moment_text(f"ts - {_SHIFT}")} end as moment,
               case when event_type <> 'error' then {day_text(f"ts - {_SHIFT}")} end as day from events""",
)
def parse_utc(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = (
        F.when(kind == "click", F.concat(local, F.lit("+01:00")))
        .when(kind == "view", F.concat(local, F.lit("-05:00")))
        .when(kind == "signup", F.concat(local, F.lit("Z")))
        .when(kind == "error", F.lit("never"))
        .otherwise(local)
    )
    moment = to_utc(written)
    return t.events.select(F.col("event_id").alias("id"), moment.alias("moment"), F.to_date(moment).alias("day"))


@query(
    "date_parts",
    f"""select event_id as id, {day_text("ts")} as day, cast(year(ts) as int) as "year",
               cast(month(ts) as int) as mes, strftime(ts, '%H:%M') as hora from events""",
)
def date_parts(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"),
        F.to_date("ts").alias("day"),
        F.year("ts").alias("year"),
        F.month("ts").alias("mes"),
        hour_minute(F.col("ts")).alias("hora"),
    )


@query(
    "seconds_to_hours",
    """select l_orderkey, l_linenumber, l_partkey, cast(l_quantity * 60 as bigint) / 3600.0::double as hours
       from lineitem""",
)
def hours_of_records(t: Tables) -> DataFrame:
    seconds = (F.col("l_quantity") * 60).cast("bigint")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", seconds_to_hours(seconds).alias("hours"))


def _gaps(t: Tables) -> DataFrame:
    """customer with nulls that follow from the other columns."""
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("tarea"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("etiqueta"),
        F.when(F.col("c_acctbal") < 9000, F.col("c_acctbal")).alias("cost"),
        F.when(F.col("c_mktsegment") == "BUILDING", roles.text("c_nationkey"))
        .when(F.col("c_mktsegment") == "MACHINERY", "none")
        .alias("children"),
    )


_GAPS = """
    select c_custkey as id, case when c_mktsegment <> 'BUILDING' then c_name end as tarea,
           case when c_acctbal >= 0 then c_mktsegment end as etiqueta,
           case when c_acctbal < 9000 then c_acctbal end as cost,
           case when c_mktsegment = 'BUILDING' then cast(c_nationkey as varchar)
                when c_mktsegment = 'MACHINERY' then 'none' end as children
    from customer"""


@query("default_blank", f"select id, coalesce(tarea, '') as tarea, coalesce(etiqueta, '') as etiqueta from ({_GAPS}) as g")
def default_blank(t: Tables) -> DataFrame:
    return _gaps(t).select("id", *[blank_if_null(F.col(c)).alias(c) for c in ("tarea", "etiqueta")])


@query(
    "default_zero",
    f"select id, coalesce(cost, 0.0) as cost, coalesce(try_cast(children as int), 0) as children from ({_GAPS}) as g",
)
def default_zero(t: Tables) -> DataFrame:
    return _gaps(t).select(
        "id",
        zero_if_null(F.col("cost"), "double").alias("cost"),
        zero_if_null(F.col("children"), "int").alias("children"),
    )


@query(
    "fill_map",
    f"""select id, coalesce(tarea, '') as tarea, coalesce(etiqueta, 'No especificada') as etiqueta, cost, children
        from ({_GAPS}) as g""",
)
def fill_map(t: Tables) -> DataFrame:
    return fill_nulls(_gaps(t), {"tarea": "", "etiqueta": "No especificada"})


@query(
    "drop_null_any",
    f"""select * from ({_GAPS}) as g where tarea is not null and etiqueta is not null and cost is not null
        and children is not null""",
)
def drop_null_any(t: Tables) -> DataFrame:
    return drop_nulls(_gaps(t))


@query("drop_null_subset", f"select * from ({_GAPS}) as g where etiqueta is not null and cost is not null")
def drop_null_subset(t: Tables) -> DataFrame:
    return drop_nulls(_gaps(t), ["etiqueta", "cost"])
