"""The loads, end to end: landing or warehouse folder in, warehouse or mart folder out.

Tables live in ``<root>/<table>``. Every job can be repeated without changing
the result. Upserting jobs return their row counts per action. ``read`` is the
reader of the landing zone: ``read_landing``, or an ``Audit``'s, which keeps
records that cannot be read and counts them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.functions import check_date_range, in_date_range, to_utc
from jornada.operators import boards, flatten
from jornada.operators.listing import with_statuses
from jornada.plans import dimensions, facts, marts
from jornada.plans.audit import Audit, audited
from jornada.session import use_utc
from jornada.sources.day_index import landed_days
from jornada.sources.landing import last_extract, read_landing
from jornada.sources.tables import (
    FIXED_PARTITIONS,
    PARTITIONS,
    SURROGATES,
    TABLE_KEYS,
    append_new_rows,
    merge_into,
    read_table,
)

Reader = Callable[..., DataFrame]
EMPLOYEE_STATUSES = ("active", "inactive")


def merge_table(spark: SparkSession, root: str, name: str, rows: DataFrame) -> dict[str, int]:
    return merge_into(
        spark,
        f"{root}/{name}",
        rows,
        TABLE_KEYS[name],
        PARTITIONS.get(name, ()),
        SURROGATES.get(name),
        rows_move=name not in FIXED_PARTITIONS,
    )


def with_entry_month(entries: DataFrame) -> DataFrame:
    start = F.col("time_entry_in")
    return entries.withColumn("entry_month", F.year(start) * 100 + F.month(start))


def landed(
    spark: SparkSession,
    landing: str,
    entity: str,
    flatten_records: Callable[..., DataFrame],
    read: Reader = read_landing,
    **days: str,
) -> DataFrame:
    """Flat records of an entity, each in its last extract."""
    raw = read(use_utc(spark), landing, entity, with_arrival=True, **days)
    return last_extract(flatten_records(raw, F.col("arrival")))


def landed_employees(spark: SparkSession, landing: str, read: Reader = read_landing) -> DataFrame:
    return with_statuses(landed(spark, landing, "employees", flatten.flatten_employees, read), EMPLOYEE_STATUSES)


def landed_assignments(spark: SparkSession, landing: str, read: Reader = read_landing) -> DataFrame:
    return landed(spark, landing, "department_assignments", flatten.flatten_department_assignments, read)


def landed_entries(
    spark: SparkSession,
    landing: str,
    from_date: str,
    to_date: str,
    read: Reader = read_landing,
    index: str | None = None,
) -> DataFrame:
    """Entries of which some version starts in the range or a day next to it, each in its last extract.

    An edited entry may be landed again on any day, so all days are read: first
    only ids and starts, to find the entries, then all of those. A range that is
    loaded again therefore never undoes a newer version. With the folder of a
    day ``index``, only the days are read on which one of their versions was landed.
    """
    first, last = check_date_range(from_date, to_date)
    one = timedelta(days=1)
    days = landed_days(use_utc(spark), landing, index, "time_entries", first - one, last + one) if index else None
    asked = {} if days is None else {"on_days": days}
    raw = read(use_utc(spark), landing, "time_entries", with_arrival=True, **asked)
    starts = raw.select("id", to_utc(F.col("timeEntryIn.date")).alias("start"))
    met = in_date_range(starts, "start", first - one, last + one).select("id").distinct()
    flat = flatten.flatten_time_entries(raw, F.col("arrival")).join(met, "id", "left_semi")
    return last_extract(flat)


def load_departments(
    spark: SparkSession, landing: str, warehouse: str, read: Reader = read_landing
) -> dict[str, int]:
    flat = landed(spark, landing, "departments", flatten.flatten_departments, read)
    return merge_table(spark, warehouse, "dim_department", dimensions.departments(flat))


def load_department_assignments(
    spark: SparkSession, landing: str, warehouse: str, read: Reader = read_landing
) -> dict[str, int]:
    rows = dimensions.department_assignments(landed_assignments(spark, landing, read))
    return merge_table(spark, warehouse, "fact_department_assignment", rows)


def load_projects(spark: SparkSession, landing: str, warehouse: str, read: Reader = read_landing) -> dict[str, int]:
    flat = landed(spark, landing, "projects", flatten.flatten_projects, read)
    return merge_table(spark, warehouse, "dim_project", dimensions.projects(flat))


def load_employees(
    spark: SparkSession, landing: str, warehouse: str, read: Reader = read_landing
) -> tuple[dict[str, int], DataFrame]:
    """Also returns the rejected rows (unknown company)."""
    companies = read_table(spark, f"{warehouse}/dim_company", "dim_company")
    rows, rejected = dimensions.employees(landed_employees(spark, landing, read), companies)
    return merge_table(spark, warehouse, "dim_employee", rows), rejected


def load_time_entries(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    from_date: str,
    to_date: str,
    read: Reader = read_landing,
    index: str | None = None,
) -> dict[str, int]:
    rows = facts.time_entries(landed_entries(spark, landing, from_date, to_date, read, index))
    rows = in_date_range(rows, "time_entry_in", *check_date_range(from_date, to_date))
    return merge_table(spark, warehouse, "fact_time_entry", with_entry_month(rows))


def load_worked_hours(
    spark: SparkSession, landing: str, warehouse: str, from_date: str, to_date: str, read: Reader = read_landing
) -> dict[str, int]:
    """Of a tenant's day that was extracted several times, the last extract counts."""
    raw = read(use_utc(spark), landing, "worked_hours", from_date=from_date, to_date=to_date, last_only=True)
    return merge_table(spark, warehouse, "fact_worked_hours", facts.worked_hours(raw))


def load_time_charges_and_signings(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    from_date: str,
    to_date: str,
    company_aliases: Sequence[tuple[str, object]] = (),
) -> None:
    """The two append-only facts, from the landing zone and the loaded dimensions."""
    first_last = check_date_range(from_date, to_date)
    lookups = (
        landed_employees(use_utc(spark), landing),
        read_table(spark, f"{warehouse}/dim_employee", "dim_employee"),
        read_table(spark, f"{warehouse}/dim_company", "dim_company"),
        landed_assignments(spark, landing),
        read_table(spark, f"{warehouse}/dim_departamento", "dim_departamento"),
    )
    entries = landed_entries(spark, landing, from_date, to_date)
    charges = facts.time_charges(entries, facts.charge_profiles(*lookups, company_aliases=company_aliases))
    _append(spark, warehouse, "fact_time_charge", in_date_range(charges, "fecha", *first_last), first_last)

    hours = read_landing(spark, landing, "worked_hours", from_date=from_date, to_date=to_date, last_only=True)
    signed = facts.signings(hours, facts.signing_profiles(*lookups, company_aliases=company_aliases))
    _append(spark, warehouse, "fact_signing", signed, first_last)


def _append(spark: SparkSession, root: str, name: str, rows: DataFrame, days) -> None:
    append_new_rows(spark, f"{root}/{name}", rows, TABLE_KEYS[name], "fecha", days, PARTITIONS[name])


def board_ids(spark: SparkSession, landing: str) -> DataFrame:
    """Board name -> id; of several boards with one name the last to arrive."""
    return boards.board_ids(read_landing(spark, landing, "boards", with_arrival=True))


def board_items(spark: SparkSession, landing: str) -> DataFrame:
    """Items of all landed boards: ``item_id, name, hours, assignment``."""
    pages = read_landing(spark, landing, "board_items", with_arrival=True)
    cell_lists = read_landing(spark, landing, "item_cells", with_arrival=True)
    return boards.items_with_cells(
        boards.board_items(pages), boards.cells(cell_lists, "arrival"), order="arrival_seq"
    )


def items_of_board(spark: SparkSession, landing: str, board_id: str) -> DataFrame:
    """Items of one landed board: ``item_id, name, hours, assignment``; pages that name no board belong to none."""
    items = boards.items_of_board(read_landing(spark, landing, "board_items", with_arrival=True), board_id)
    cell_lists = read_landing(spark, landing, "item_cells", with_arrival=True)
    own = boards.cells_of_items(boards.cells(cell_lists, "arrival"), items)
    return boards.items_with_cells(items, own, order="arrival_seq")


def build_mart_time_entries(
    spark: SparkSession, warehouse: str, mart: str, from_date: str, to_date: str
) -> dict[str, int]:
    first, last = check_date_range(from_date, to_date)
    use_utc(spark)
    months = (first.year * 100 + first.month, last.year * 100 + last.month)
    entries = read_table(spark, f"{warehouse}/fact_time_entry", "fact_time_entry")
    if "entry_month" in entries.columns:
        entries = entries.where(F.col("entry_month").between(*months)).drop("entry_month")
    names = ("dim_project", "dim_employee", "fact_department_assignment", "dim_department")
    others = [read_table(spark, f"{warehouse}/{name}", name) for name in names]
    return merge_table(spark, mart, "mart_time_entry", marts.mart_time_entries(entries, *others, from_date, to_date))


def build_mart_worked_hours(
    spark: SparkSession, warehouse: str, mart: str, from_date: str, to_date: str
) -> dict[str, int]:
    use_utc(spark)
    worked = read_table(spark, f"{warehouse}/fact_worked_hours", "fact_worked_hours")
    people = read_table(spark, f"{warehouse}/dim_employee", "dim_employee")
    return merge_table(spark, mart, "mart_worked_hours", marts.mart_worked_hours(worked, people, from_date, to_date))


def load_employees_audited(
    spark: SparkSession, landing: str, warehouse: str, load_id: str | None = None, most_rejected: float = 1.0
) -> dict[str, int]:
    """Employees with every reason for a rejection stored: unreadable records, dates and numbers, unknown companies."""

    def load(audit: Audit) -> dict[str, int]:
        def read(*args, **asked) -> DataFrame:
            return audit.read(*args, **asked)

        landed_rows = landed_employees(spark, landing, read)
        flat = audit.accept_parsed(landed_rows, "employees", dimensions.employee_parses(), count_read=False)
        companies = read_table(spark, f"{warehouse}/dim_company", "dim_company")
        rows, unknown = dimensions.employees(flat, companies)
        audit.reject(unknown.select("empleado_sesame_id", "empresa_sesame_id"), "employees", "unknown company")
        return merge_table(spark, warehouse, "dim_employee", rows)

    return audited(spark, warehouse, "dim_employee", load, load_id, most_rejected)
