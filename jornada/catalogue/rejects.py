"""Records and values that cannot be read, with their reasons."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jornada.catalogue import roles
from jornada.catalogue.registry import Tables, query
from jornada.functions.parse import errors, parsed_day_first, parsed_decimal, parsed_moment
from jornada.plans.audit import Audit
from jornada.session import checkpoint_folder
from jornada.sources.quarantine import checked_records
from jornada.sources.tables import merge_into, read_table

_RECORD = "id string, price double, amounts array<double>, owner struct<id: bigint>"

# Each order is a page of one record; by turns a good one, and six kinds of bad ones.
_TURN = "o_orderkey % 7"


def _pages(t: Tables) -> DataFrame:
    key, total = roles.text("o_orderkey"), roles.text("o_totalprice")
    turn = F.col("o_orderkey") % 7

    def record(price, amounts="[1.5]", owner='{"id": 7}'):
        return F.concat(F.lit('{"id": "'), key, F.lit('", "price": '), price, F.lit(f', "amounts": {amounts}, "owner": {owner}}}'))

    good = record(total)
    bad = {
        1: record(F.concat(F.lit('"about '), total, F.lit('"'))),
        2: record(total, amounts='"many"'),
        3: record(total, owner='{"id": "seven"}'),
        4: F.lit("null"),
    }
    text = good
    for number, other in bad.items():
        text = F.when(turn == number, other).otherwise(text)
    page = F.concat(F.lit('{"data": ['), text, F.lit("]}"))
    page = F.when(turn == 5, F.concat(F.lit('{"data": [{"id": "'), key)).when(turn == 6, F.lit('{"items": []}')).otherwise(page)
    parsed = F.from_json(page, "data array<string>, bad_page string", {"columnNameOfCorruptRecord": "bad_page"})
    return t.orders.select("o_orderkey", parsed.alias("page")).select("o_orderkey", "page.*")


@query(
    "landing_rejects",
    f"""select o_orderkey, case when {_TURN} = 0 then cast(o_orderkey as varchar) when {_TURN} in (1, 2, 3) then
                   cast(o_orderkey as varchar) end as id,
               case {_TURN} when 1 then 'price' when 2 then 'amounts' end as field,
               case {_TURN} when 0 then null when 4 then 'no record' when 5 then 'malformed page'
                    when 6 then 'page without data' else 'wrong type' end as reason
        from orders""",
)
def landing_rejects(t: Tables) -> DataFrame:
    """Every record of the pages, those that cannot be read with the field and the reason."""
    checked = checked_records(_pages(t), StructType.fromDDL(_RECORD), ["o_orderkey"])
    first = F.col("reject.errors")[0]
    return checked.select("o_orderkey", "id", first["field"].alias("field"), first["reason"].alias("reason"))


def _written(t: Tables) -> DataFrame:
    """Dates, costs and moments as texts, some of which are none."""
    turn = F.col("o_orderkey") % 6
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey",
        F.when(turn == 1, "soon").when(turn == 2, "31/02/2020").when(turn == 3, " ").otherwise(day).alias("day"),
        F.when(turn == 2, "n/a").otherwise(F.replace(roles.text("o_totalprice"), F.lit("."), F.lit(","))).alias("cost"),
        F.when(turn == 4, "noon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("at"),
    )


def _rules() -> dict:
    rules = {"day": parsed_day_first, "cost": parsed_decimal, "at": parsed_moment}
    return {name: (F.col(name), rule(F.col(name))) for name, rule in rules.items()}


_PARSE_ERRORS = """
    select o_orderkey, 'day' as field, 'no known date format' as reason, 'soon' as text from orders where o_orderkey % 6 = 1
    union all select o_orderkey, 'day', 'no such day', '31/02/2020' from orders where o_orderkey % 6 = 2
    union all select o_orderkey, 'cost', 'not a number', 'n/a' from orders where o_orderkey % 6 = 2
    union all select o_orderkey, 'at', 'not a point in time', 'noon' from orders where o_orderkey % 6 = 4"""


@query("parse_rejects", _PARSE_ERRORS)
def parse_rejects(t: Tables) -> DataFrame:
    """What could not be read, one row per value."""
    return _written(t).select("o_orderkey", F.explode(errors(_rules())).alias("error")).select("o_orderkey", "error.*")


@query(
    "load_audit",
    """select 'orders' as name, count(*) as read, count(*) filter (o_orderkey % 6 in (1, 2, 4)) as rejected,
              count(*) filter (o_orderkey % 6 not in (1, 2, 4)) as "insert", 0 as "update", 0 as unchanged
       from orders
       union all
       select 'orders again', count(*), count(*) filter (o_orderkey % 6 in (1, 2, 4)), 0,
              count(*) filter (o_orderkey % 6 = 0), count(*) filter (o_orderkey % 6 in (3, 5)) from orders""",
)
def load_audit(t: Tables) -> DataFrame:
    """Two loads into a table and the rows of counts that they leave: read, rejected, and done to the table."""
    warehouse = f"{checkpoint_folder(t.spark)}/loads/{uuid.uuid4().hex}"
    for name, cost in (("orders", F.col("cost")), ("orders again", F.when(F.col("o_orderkey") % 6 == 0, "1,5").otherwise(F.col("cost")))):
        audit = Audit(t.spark, warehouse)
        rows = audit.accept_parsed(_written(t).withColumn("cost", cost), "orders", _rules())
        audit.close(name, merge_into(t.spark, f"{warehouse}/orders", rows, ["o_orderkey"]))
    return read_table(t.spark, f"{warehouse}/load_audit").select("name", "read", "rejected", "insert", "update", "unchanged")
