"""Edits, inserts, boards, files and listings of single entities."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, moment_text, query
from jornada.operators import boards, flatten, listing
from jornada.operators.positions import PositionIndex
from jornada.plans.edits import load_cell_edits, load_new_employees
from jornada.session import checkpoint_folder
from jornada.sources.csv_text import read_csv, write_csv
from jornada.sources.landing import with_company_id
from jornada.sources.tables import read_table


def _warehouse(t: Tables) -> str:
    return f"{checkpoint_folder(t.spark)}/loads/{uuid.uuid4().hex}"


# ---- edits and inserts as loads

_EDITS = "select *, event_id % 11 = 0 as broken from events"


@query(
    "cell_edit_load",
    f"""select cast(user_id % 3 as varchar) as board_id, cast(user_id as varchar) as item_id, event_type as column_id,
               arg_max(props, struct_pack(a := date_trunc('second', ts), b := cast(event_id as varchar))) as value
        from ({_EDITS}) as e where not broken group by 1, 2, 3""",
)
def cell_edit_load(t: Tables) -> DataFrame:
    """Edits loaded in three parts, the last ones first and all of them again; some have no moment."""
    id_, user = F.col("event_id"), F.col("user_id")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    edits = t.events.select(
        roles.text("event_id").alias("edit_id"),
        (user % 3).cast("string").alias("board_id"),
        user.cast("string").alias("item_id"),
        F.col("event_type").alias("column_id"),
        F.col("props").alias("value"),
        F.when(id_ % 11 != 0, at).when(id_ % 2 == 0, "yesterday").alias("edited_at"),
    )
    warehouse, part = _warehouse(t), F.substring("edited_at", 9, 2)
    for chosen in (part > "20", part <= "20", F.lit(True)):
        load_cell_edits(t.spark, warehouse, edits.where(chosen))
    return read_table(t.spark, f"{warehouse}/board_cells").select(*boards.CELL_KEY, "value")


_NEW = """
    select cast(c_nationkey as varchar) as "companyId", c_name as "firstName", c_mktsegment as "lastName",
           case when c_acctbal >= 1000 then lower(c_name) end as email, cast(c_custkey // 2 as varchar) as nid, c_custkey
    from customer"""


@query(
    "employee_insert_load",
    f"""select "companyId", "firstName", nid from ({_NEW}) as n where email is not null
        and not exists (select 1 from ({_NEW}) as o where o."companyId" = n."companyId" and o.nid = n.nid
                        and o.email is not null and o.c_custkey < n.c_custkey)""",
)
def employee_insert_load(t: Tables) -> DataFrame:
    """New employees, of whom some lack a field or repeat another's company and national id; loaded twice."""
    name = F.col("c_name")
    new = t.customer.select(
        roles.text("c_nationkey").alias("companyId"),
        name.alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.when(F.col("c_acctbal") >= 1000, F.lower(name)).alias("email"),
        F.floor(F.col("c_custkey") / 2).cast("string").alias("nid"),
    )
    warehouse = _warehouse(t)
    for _ in range(2):
        load_new_employees(t.spark, warehouse, new)
    return read_table(t.spark, f"{warehouse}/employee_requests").select("companyId", "firstName", "nid")


# ---- boards


def _board_pages(t: Tables) -> DataFrame:
    """Pages of a board's items, one per event; an event of a later time renames the item."""
    item = F.struct(roles.text("user_id").alias("id"), F.col("props").alias("name"))
    return t.events.select(F.col("event_type").alias("board_id"), F.array(item).alias("items"), F.struct("ts", "event_id").alias("arrival"))


_ITEMS_OF_BOARD = """
    select cast(user_id as varchar) as item_id, arg_max(props, struct_pack(a := ts, b := event_id)) as name
    from events where event_type = 'purchase' group by 1"""


@query("board_items_of_board", _ITEMS_OF_BOARD)
def board_items_of_board(t: Tables) -> DataFrame:
    return boards.items_of_board(_board_pages(t), "purchase")


@query(
    "board_cells_of_items",
    """select cast(user_id as varchar) as item_id, cast(event_id as varchar) as cell from events
       where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def board_cells_of_items(t: Tables) -> DataFrame:
    cells = t.events.select(roles.text("user_id").alias("item_id"), roles.text("event_id").alias("cell"))
    chosen = t.customer.where("c_mktsegment = 'BUILDING'").select(roles.text("c_custkey").alias("item_id"))
    return boards.cells_of_items(cells, chosen)


# ---- files and accounts


@query(
    "csv_files",
    """select p_partkey, p_name || ', "' || p_type || '"' as p_name,
              case when p_type = 'PROMO' then null else p_brand end as p_brand, p_retailprice from part""",
)
def csv_files(t: Tables) -> DataFrame:
    """Written to CSV files and read back."""
    rows = t.part.select(
        "p_partkey",
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias("p_name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("p_brand"),
        "p_retailprice",
    )
    folder = _warehouse(t)
    write_csv(rows, folder)
    return read_csv(t.spark, folder, rows.schema)


@query(
    "company_of_account",
    "select p_partkey as id, case when p_size >= 10 then 'C-' || p_brand end as company_id from part",
)
def company_of_account(t: Tables) -> DataFrame:
    """Each tenant's company from its account record; some tenants have none."""
    tenant = F.when(F.col("p_size") >= 10, F.col("p_brand")).otherwise("without account")
    projects = t.part.select(F.col("p_partkey").alias("id"), tenant.alias("tenant"))
    company = F.struct(F.concat(F.lit("C-"), "p_brand").alias("id"))
    accounts = t.part.select(F.col("p_brand").alias("tenant"), company.alias("company")).distinct()
    return with_company_id(projects, accounts).select("id", "company_id")


# ---- listings


@query(
    "listing_assignments",
    f"""select * from ({roles.RAW_ASSIGNMENTS}) as a where department_id = '2'
        and employee_id = (select cast(min(o_custkey) as varchar) from orders where substr(o_orderpriority, 1, 1) = '3')""",
)
def listing_assignments(t: Tables) -> DataFrame:
    """Assignments of one employee to one department."""
    first = t.orders.where("substring(o_orderpriority, 1, 1) = '3'").agg(F.min("o_custkey")).first()[0]
    flat = flatten.flatten_department_assignments(roles.raw_assignments(t))
    return listing.list_entity(flat, "department_assignments", employee_id=str(first), department_id="2")


@query(
    "listing_projects",
    """select cast(p_partkey as varchar) as id, p_name as name, 'C-' || p_brand as company_id from part
       where p_brand = 'Brand#13' order by p_name desc, cast(p_partkey as varchar) limit 10 offset 10""",
)
def listing_projects(t: Tables) -> DataFrame:
    """Projects of one company, by name."""
    raw = roles.raw_projects(t).join(t.part.select(roles.text("p_partkey").alias("id"), "p_brand"), "id")
    company = F.concat(F.lit("C-"), "p_brand").alias("company_id")
    flat = flatten.flatten_projects(raw, company)
    page = listing.list_entity(flat, "projects", company_id="C-Brand#13", order_by="name desc", limit=10, page=2)
    return page.select("id", "name", "company_id")


@query("listing_departments", "select cast(n_nationkey as varchar) as id, n_name as name from nation where n_name = 'NATION_7'")
def listing_departments(t: Tables) -> DataFrame:
    raw = t.nation.select(roles.text("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return listing.list_entity(flatten.flatten_departments(raw), "departments", name="NATION_7")


_DEEP = 37


@query(
    "listing_page_deep",
    f"""select event_id as id, user_id as employee_id, event_type, {moment_text("ts")} as ts
        from (select *, row_number() over (order by event_type desc, user_id, event_id) as place from events) as e
        where place > (select count(*) // {_DEEP} from events) * 20
        and place <= (select count(*) // {_DEEP} from events) * 20 + 2 * (select count(*) // {_DEEP} from events)""",
)
def listing_page_deep(t: Tables) -> DataFrame:
    """Two pages from far down a listing, through one index of positions."""
    rows = t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("employee_id"), "event_type", "ts")
    with PositionIndex(rows, "event_type desc, employee_id", ["id"]) as index:
        limit = max(1, index.rows // _DEEP)
        return index.page(limit, 21).union(index.page(limit, 22))
