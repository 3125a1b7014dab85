"""Sources, flattening, day spine and board queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, query
from jornada.functions import custom_field, day_spine, in_date_range, quoted_token, tag_names
from jornada.operators import boards, flatten
from jornada.operators.daily import missing_days
from jornada.operators.listing import by_id, with_statuses
from jornada.sources.csv_text import from_csv_lines, to_csv_lines
from jornada.sources.landing import union_tenants


@query(
    "landing_union",
    """select 'customers' as tenant, c_custkey as id, c_name as name, c_mktsegment as segment from customer
       union all select 'suppliers', s_suppkey, s_name, null from supplier
       union all select 'customers', c_custkey, c_name, c_mktsegment from customer where c_acctbal < 0""",
)
def landing_union(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.lit("customers").alias("tenant"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        "c_acctbal",
    )
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.lit("suppliers").alias("tenant")
    )
    again = customers.where("c_acctbal < 0")
    return union_tenants(customers.drop("c_acctbal"), suppliers, again.drop("c_acctbal"))


@query(
    "employees_by_status",
    """select * from (select c_custkey as id, c_name as name,
            case when c_acctbal < 0 then 'inactive' when c_acctbal < 5000 then 'active' else 'on leave' end as status
          from customer) as e where status in ('active', 'inactive')""",
)
def employees_by_status(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    status = F.when(balance < 0, "inactive").when(balance < 5000, "active").otherwise("on leave")
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), status.alias("status"))
    return with_statuses(people, ["active", "inactive"])


@query("employee_by_id", "select c_custkey as id, c_name as name, c_acctbal as cost from customer where c_custkey = 42")
def employee_by_id(t: Tables) -> DataFrame:
    people = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("cost")
    )
    return by_id(people, "id", 42)


@query(
    "scan_date_range",
    f"""select event_id as id, {day_text("ts")} as day, event_type as tags from events
        where cast(ts as date) between date '{roles.FROM_DATE}' and date '{roles.TO_DATE}'""",
)
def scan_date_range(t: Tables) -> DataFrame:
    first, last = date.fromisoformat(roles.FROM_DATE), date.fromisoformat(roles.TO_DATE)
    chosen = in_date_range(t.events, "ts", first, last)
    return chosen.select(
        F.col("event_id").alias("id"), F.to_date("ts").alias("day"), F.col("event_type").alias("tags")
    )


@query(
    "day_spine",
    f"""select {day_text("d.day")} as "date", cast(count(e.event_id) as bigint) as records
        from (select unnest(generate_series(date '2023-12-28', date '2024-02-05', interval 1 day)) as day) as d
        left join events as e on cast(e.ts as date) = cast(d.day as date)
        group by 1""",
)
def day_spine_counts(t: Tables) -> DataFrame:
    spine = day_spine(t.spark, date(2023, 12, 28), date(2024, 2, 5))
    return missing_days(t.events.select(F.to_date("ts").alias("date")), spine)


def _raw_work_entries(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    moment = "yyyy-MM-dd HH:mm:ss"
    return t.events.select(
        roles.text("event_id").alias("id"),
        F.when(kind != "error", F.struct(roles.text("user_id").alias("id"))).alias("employee"),
        kind.alias("workEntryType"),
        F.round(F.col("value") * 60).cast("bigint").alias("workedSeconds"),
        F.struct(F.date_format("ts", moment).alias("date")).alias("workEntryIn"),
        F.when(F.col("value") < 100, F.struct(F.date_format(roles.entry_end(), moment).alias("date"))).alias(
            "workEntryOut"
        ),
        F.lit(None).cast("string").alias("workBreakId"),
    )


@query(
    "work_entries_valid",
    """select cast(event_id as varchar) as id, cast(user_id as varchar) as employee_id,
              event_type as work_entry_type, cast(round(value * 60) as bigint) as worked_seconds,
              strftime(ts, '%Y-%m-%d %H:%M:%S') as work_entry_in_datetime,
              strftime(ts + to_seconds(cast(round(value * 60) as bigint)), '%Y-%m-%d %H:%M:%S')
                  as work_entry_out_datetime,
              cast(null as varchar) as work_break_id
       from events where event_type <> 'error' and value < 100""",
)
def work_entries_valid(t: Tables) -> DataFrame:
    return flatten.flatten_work_entries(_raw_work_entries(t))[0]


@query(
    "work_entries_rejected",
    """select cast(event_id as varchar) as id, event_type as work_entry_type
       from events where event_type = 'error' or value >= 100""",
)
def work_entries_rejected(t: Tables) -> DataFrame:
    rejected = flatten.flatten_work_entries(_raw_work_entries(t))[1]
    return rejected.select("id", F.col("workEntryType").alias("work_entry_type"))


@query("flatten_nested", roles.RAW_ASSIGNMENTS)
def flatten_nested(t: Tables) -> DataFrame:
    return flatten.flatten_department_assignments(roles.raw_assignments(t))


@query(
    "custom_field_lookup",
    """select event_id as id,
              case when event_type = 'error' then null when event_type = 'view' then 'later' else props end as cf_area,
              case when event_type = 'error' then null else event_type end as cf_studies,
              cast(null as varchar) as cf_work_phone
       from events""",
)
def custom_field_lookup(t: Tables) -> DataFrame:
    kind = F.col("event_type")

    def field(slug, value):
        return F.struct(F.lit(slug).alias("slug"), value.alias("value"))

    later = field("cf_rea", F.lit("later"))
    fields = (
        F.when(kind == "error", F.array().cast("array<struct<slug:string,value:string>>"))
        .when(kind == "view", F.array(field("ccf_studies", kind), later))
        .otherwise(F.array(field("cf_rea", F.col("props")), field("ccf_studies", kind), later))
    )
    return t.events.select(F.col("event_id").alias("id"), fields.alias("fields")).select(
        "id",
        custom_field(F.col("fields"), "cf_rea").alias("cf_area"),
        custom_field(F.col("fields"), "ccf_studies").alias("cf_studies"),
        custom_field(F.col("fields"), "cf_work_phone").alias("cf_work_phone"),
    )


@query(
    "tags_joined",
    """select event_id as id,
              case when event_type = 'error' then ''
                   when event_type = 'view' then event_type
                   else event_type || ',' || props || ',' || event_type end as tags
       from events""",
)
def tags_joined(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    tag = F.struct(kind.alias("name"))
    tags = (
        F.when(kind == "error", F.array().cast("array<struct<name:string>>"))
        .when(kind == "view", F.array(tag))
        .otherwise(F.array(tag, F.struct(F.col("props").alias("name")), tag))
    )
    return t.events.select(F.col("event_id").alias("id"), tag_names(tags).alias("tags"))


@query(
    "csv_roundtrip",
    """select p_partkey, p_name || ', "' || p_type || '"' as p_name,
              case when p_type = 'PROMO' then null else p_brand end as p_brand, p_retailprice from part""",
)
def csv_roundtrip(t: Tables) -> DataFrame:
    rows = t.part.select(
        "p_partkey",
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias("p_name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("p_brand"),
        "p_retailprice",
    )
    return from_csv_lines(to_csv_lines(rows), rows.schema)


@query(
    "json_field",
    """select event_id as id, 'k' as second_token, cast(null as varchar) as fourth_token,
              json_extract_string(props, '$.k') as k from events""",
)
def json_field(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"),
        quoted_token(F.col("props"), 1).alias("second_token"),
        quoted_token(F.col("props")).alias("fourth_token"),
        F.get_json_object("props", "$.k").alias("k"),
    )


@query(
    "board_map",
    """select name, arg_max(event_id, struct_pack(a := ts, b := event_id)) as id
       from (select event_type || ' ' || props as name, ts, event_id from events) as b group by name""",
)
def board_map(t: Tables) -> DataFrame:
    listed = t.events.select(
        F.concat_ws(" ", "event_type", "props").alias("name"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("arrival"),
    )
    return boards.board_ids(listed)


@query(
    "board_cells_pivot",
    """select i.item_id, i.name, coalesce(c.hours, '0') as hours, coalesce(c.assignment, '') as assignment
       from (select cast(c_custkey as varchar) as item_id, c_name as name from customer) as i
       left join (
           select cast(user_id as varchar) as item_id,
                  arg_max(cast(event_id as varchar), event_id) filter (where event_type = 'click') as hours,
                  arg_max(json_extract_string(props, '$.k'), event_id) filter (where event_type = 'purchase')
                      as assignment
           from events group by 1) as c on c.item_id = i.item_id""",
)
def board_cells_pivot(t: Tables) -> DataFrame:
    label = F.concat(F.lit('{"label":"'), F.get_json_object("props", "$.k"), F.lit('"}'))
    value = (
        F.when(F.col("event_type") == "purchase", label)
        .when(F.col("event_type") == "click", F.col("event_id").cast("string"))
        .otherwise(F.lit(""))
    )
    cells = t.events.select(
        roles.text("user_id").alias("item_id"),
        F.col("event_type").alias("column_id"),
        value.alias("value"),
        F.col("event_id").alias("seq"),
    )
    items = t.customer.select(roles.text("c_custkey").alias("item_id"), F.col("c_name").alias("name"))
    return boards.items_with_cells(items, cells, hours_column="click", assignment_column="purchase")


@query(
    "apply_cell_edits",
    """with cells as (select distinct cast(user_id as varchar) as item_id, event_type as column_id
                      from events where value < 20),
            edits as (select cast(user_id as varchar) as item_id, event_type as column_id,
                             arg_max(props, struct_pack(a := ts, b := event_id)) as value
                      from events where value >= 10 group by 1, 2)
       select 'b1' as board_id, coalesce(c.item_id, e.item_id) as item_id,
              coalesce(c.column_id, e.column_id) as column_id,
              case when e.item_id is not null then e.value else 'start' end as value
       from cells as c full outer join edits as e on e.item_id = c.item_id and e.column_id = c.column_id""",
)
def apply_cell_edits(t: Tables) -> DataFrame:
    cell = (F.lit("b1").alias("board_id"), roles.text("user_id").alias("item_id"), F.col("event_type").alias("column_id"))
    table = t.events.where("value < 20").select(*cell).distinct().withColumn("value", F.lit("start"))
    edits = t.events.where("value >= 10").select(*cell, F.col("props").alias("value"), "ts", "event_id")
    return boards.apply_cell_edits(table, edits, edited_at="ts", tie_break="event_id")
