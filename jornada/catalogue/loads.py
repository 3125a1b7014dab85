"""Change classification, upsert, append-new, delete and key joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, day_text, moment_text, query
from jornada.operators import merge
from jornada.operators.daily import daily_worked_hours
from jornada.operators.latest import latest_generation, latest_values
from jornada.operators.quality import missing_fields, reject_missing
from jornada.session import checkpoint_folder
from jornada.sources.tables import merge_into, read_table

# The table as it was: orders without the pending ones. The new extract: all but
# the finished ones, with some totals changed and some lost.
_TARGET = "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders where o_orderstatus in ('F', 'O')"
_SOURCE = """
    select o_orderkey, o_custkey,
           case o_orderpriority when '1-URGENT' then o_totalprice * 2 when '5-LOW' then null
                else o_totalprice end as o_totalprice
    from orders where o_orderstatus in ('O', 'P')"""
_CLASSIFIED = f"""
    select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
           case when s.o_orderkey is null then t.o_custkey else s.o_custkey end as o_custkey,
           case when s.o_orderkey is null then t.o_totalprice else s.o_totalprice end as o_totalprice,
           t.o_orderpriority,
           case when t.o_orderkey is null then 'insert' when s.o_orderkey is null then 'keep'
                when t.o_custkey is distinct from s.o_custkey or t.o_totalprice is distinct from s.o_totalprice
                then 'update' else 'unchanged' end as action
    from ({_TARGET}) as t full outer join ({_SOURCE}) as s on t.o_orderkey = s.o_orderkey"""


def _target(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


def _source(t: Tables) -> DataFrame:
    priority, total = F.col("o_orderpriority"), F.col("o_totalprice")
    changed = F.when(priority == "1-URGENT", total * 2).when(priority == "5-LOW", None).otherwise(total)
    return t.orders.where(F.col("o_orderstatus").isin("O", "P")).select(
        "o_orderkey", "o_custkey", changed.alias("o_totalprice")
    )


@query("classify_changes", _CLASSIFIED)
def classify_changes(t: Tables) -> DataFrame:
    return merge.classify_changes(_target(t), _source(t), ["o_orderkey"])


@query(
    "upsert_single_key",
    f"select o_orderkey, o_custkey, o_totalprice, o_orderpriority from ({_CLASSIFIED}) as c",
)
def upsert_single_key(t: Tables) -> DataFrame:
    return merge.upsert(_target(t), _source(t), ["o_orderkey"])


@query(
    "load_metrics",
    f"""select action, cast(count(*) as bigint) as "rows" from ({_CLASSIFIED}) as c group by action
        union all
        select unnest(['read', 'rejected']) as action,
               unnest([count(*), count(*) filter (o_orderpriority = '5-LOW')]) as "rows"
        from orders where o_orderstatus in ('O', 'P')""",
)
def load_metrics(t: Tables) -> DataFrame:
    """What a load reads, rejects for lack of a total, and does to the table's rows."""
    source = _source(t)
    read = source.select(F.lit("read").alias("action"))
    rejected = reject_missing(source, ["o_totalprice"])[1].select(F.lit("rejected").alias("action"))
    done = merge.classify_changes(_target(t), source, ["o_orderkey"]).select("action")
    return merge.count_actions(done.union(read).union(rejected))


_LAST = """
    select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders where {where}
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""
_STALE_TARGET = _LAST.format(where="o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')")
_STALE_SOURCE = _LAST.format(where="o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')")
_ORDER_VERSION = ("o_orderdate", "o_orderkey")


def _last_orders(t: Tables, *priorities: str) -> DataFrame:
    chosen = t.orders.where(F.col("o_orderpriority").isin(*priorities)) if priorities else t.orders
    return latest_values(chosen, ["o_custkey"], ["o_orderkey", "o_orderdate", "o_totalprice"], *_ORDER_VERSION)


_STALE_ACTION = """
    case when t.o_custkey is null then 'insert' when s.o_custkey is null then 'keep'
         when t.o_orderdate > s.o_orderdate or t.o_orderdate = s.o_orderdate and t.o_orderkey > s.o_orderkey then 'stale'
         when t.o_orderkey <> s.o_orderkey then 'update' else 'unchanged' end"""


def _taken(column: str) -> str:
    return f"case when {_STALE_ACTION} in ('keep', 'stale') then t.{column} else s.{column} end"


@query(
    "merge_stale",
    f"""select coalesce(t.o_custkey, s.o_custkey) as o_custkey, {_taken("o_orderkey")} as o_orderkey,
               {moment_text(_taken("o_orderdate"))} as o_orderdate, {_taken("o_totalprice")} as o_totalprice,
               {_STALE_ACTION} as action
        from ({_STALE_TARGET}) as t full outer join ({_STALE_SOURCE}) as s on t.o_custkey = s.o_custkey""",
)
def merge_stale(t: Tables) -> DataFrame:
    """An extract with each customer's last order; what the table has of a later order stays."""
    target = _last_orders(t, "1-URGENT", "2-HIGH", "3-MEDIUM")
    source = _last_orders(t, "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    return merge.classify_changes(target, source, ["o_custkey"], version=_ORDER_VERSION)


@query(
    "merge_out_of_order",
    f"select o_custkey, o_orderkey, {moment_text('o_orderdate')} as o_orderdate, o_totalprice from ({_LAST.format(where='true')}) as l",
)
def merge_out_of_order(t: Tables) -> DataFrame:
    """Stored loads of which later ones bring older versions; the table is that of the right order."""
    table = f"{checkpoint_folder(t.spark)}/loads/{uuid.uuid4().hex}"
    for priorities in (("5-LOW", "1-URGENT"), ("2-HIGH",), ("3-MEDIUM", "4-NOT SPECIFIED")):
        merge_into(t.spark, table, _last_orders(t, *priorities), ["o_custkey"], version=_ORDER_VERSION)
    return read_table(t.spark, table)


_EXTRACTED = f"""select c.*, case l_returnflag when 'A' then null else l_returnflag end as extract
                 from ({roles.CLOCK_RECORDS}) as c"""


@query(
    "worked_hours_reextract",
    f"""select "employeeId", {day_text('"date"')} as "date", cast(sum("secondsWorked") as bigint) as "secondsWorked",
               cast(sum("secondsToWork") as bigint) as "secondsToWork",
               cast(sum("secondsBalance") as bigint) as "secondsBalance"
        from ({_EXTRACTED}) as r
        where extract is not distinct from (select max(extract) from ({_EXTRACTED}) as o where o."date" = r."date")
        group by 1, 2""",
)
def worked_hours_reextract(t: Tables) -> DataFrame:
    """Days that were extracted up to three times; only the last extract of a day is added up."""
    flag = F.col("l_returnflag")
    extracted = roles.clock_records(t).withColumn("extract", F.when(flag != "A", flag))
    return daily_worked_hours(latest_generation(extracted, ["date"], "extract"))


def _daily_sql(flags: str) -> str:
    return f"""select "employeeId", "date", cast(sum("secondsWorked") as bigint) as "secondsWorked",
                      cast(sum("secondsToWork") as bigint) as "secondsToWork"
               from ({roles.CLOCK_RECORDS}) as c where l_returnflag in ({flags}) group by 1, 2"""


@query(
    "upsert_composite_key",
    f"""select coalesce(t."employeeId", s."employeeId") as "employeeId",
               {day_text('coalesce(t."date", s."date")')} as "date",
               case when s."date" is null then t."secondsWorked" else s."secondsWorked" end as "secondsWorked",
               case when s."date" is null then t."secondsToWork" else s."secondsToWork" end as "secondsToWork"
        from ({_daily_sql("'A', 'N'")}) as t full outer join ({_daily_sql("'N', 'R'")}) as s
        on t."employeeId" = s."employeeId" and t."date" = s."date" """,
)
def upsert_composite_key(t: Tables) -> DataFrame:
    target, source = _daily(t, "A", "N"), _daily(t, "N", "R")
    return merge.upsert(target, source, ["employeeId", "date"])


def _daily(t: Tables, *flags: str) -> DataFrame:
    chosen = roles.clock_records(t).where(F.col("l_returnflag").isin(*flags))
    return daily_worked_hours(chosen, seconds=("secondsWorked", "secondsToWork"))


@query(
    "anti_new_composite",
    f"""select "employeeId", {day_text('"date"')} as "date", "secondsWorked", "secondsToWork"
        from ({_daily_sql("'N', 'R'")}) as s
        where not exists (select 1 from ({_daily_sql("'A', 'N'")}) as t
                          where t."employeeId" = s."employeeId" and t."date" = s."date")""",
)
def anti_new_composite(t: Tables) -> DataFrame:
    return merge.rows_with_new_key(_daily(t, "N", "R"), _daily(t, "A", "N"), ["employeeId", "date"])


@query("anti_new", f"{_SOURCE} and o_orderkey not in (select o_orderkey from ({_TARGET}) as t)")
def anti_new(t: Tables) -> DataFrame:
    return merge.rows_with_new_key(_source(t), _target(t), ["o_orderkey"])


@query("semi_existing", f"{_SOURCE} and o_orderkey in (select o_orderkey from ({_TARGET}) as t)")
def semi_existing(t: Tables) -> DataFrame:
    return merge.rows_with_known_key(_source(t), _target(t), ["o_orderkey"])


_NULLABLE = "case when o_orderpriority = '5-LOW' then null else o_custkey end as customer, o_orderkey"


@query(
    "anti_null_safe",
    f"""select * from (select {_NULLABLE} from orders where o_orderstatus in ('O', 'P')) as s
        where not exists (select 1 from (select {_NULLABLE} from orders where o_totalprice < 50000) as t
                          where t.customer is not distinct from s.customer)""",
)
def anti_null_safe(t: Tables) -> DataFrame:
    customer = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer")
    incoming = t.orders.where(F.col("o_orderstatus").isin("O", "P")).select(customer, "o_orderkey")
    existing = t.orders.where("o_totalprice < 50000").select(customer)
    return merge.rows_with_new_key(incoming, existing, ["customer"], repeated=True)


_CHARGE = f"o_custkey, {moment_text('o_orderdate')} as o_orderdate, o_orderpriority, o_totalprice"


@query(
    "append_new",
    f"""select {_CHARGE} from orders where o_orderstatus in ('F', 'O')
        union all
        select {_CHARGE} from orders as s where o_orderstatus in ('O', 'P')
        and not exists (select 1 from orders as t where t.o_orderstatus in ('F', 'O')
                        and t.o_custkey = s.o_custkey and t.o_orderdate = s.o_orderdate)""",
)
def append_new(t: Tables) -> DataFrame:
    columns = ["o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"]
    existing = t.orders.where(F.col("o_orderstatus").isin("F", "O")).select(*columns)
    incoming = t.orders.where(F.col("o_orderstatus").isin("O", "P")).select(*columns)
    return merge.append_new(existing, incoming, ["o_custkey", "o_orderdate"])


@query(
    "delete_by_key",
    """select o_orderkey, o_custkey, o_totalprice from orders
       where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""",
)
def delete_by_key(t: Tables) -> DataFrame:
    gone = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.delete_by_key(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), gone, ["o_orderkey"])


@query(
    "validate_required",
    """select id, concat_ws(',',
                case when coalesce("companyId", '') = '' then 'companyId' end,
                case when coalesce("firstName", '') = '' then 'firstName' end,
                case when coalesce("lastName", '') = '' then 'lastName' end,
                case when coalesce(email, '') = '' then 'email' end,
                case when coalesce(nid, '') = '' then 'nid' end) as missing_fields
       from (select c_custkey as id, cast(c_nationkey as varchar) as "companyId",
                    case when c_mktsegment = 'BUILDING' then '' else c_name end as "firstName",
                    c_mktsegment as "lastName",
                    case when c_acctbal < 1000 then null else c_name end as email,
                    case when c_acctbal < 0 then '' else c_name end as nid
             from customer) as e""",
)
def validate_required(t: Tables) -> DataFrame:
    name, balance = F.col("c_name"), F.col("c_acctbal")
    new = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("companyId"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(name).alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.when(balance >= 1000, name).alias("email"),
        F.when(balance < 0, "").otherwise(name).alias("nid"),
    )
    return new.select("id", missing_fields().alias("missing_fields"))
