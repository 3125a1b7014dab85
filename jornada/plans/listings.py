"""The seven listings over the landing zone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.functions import check_date_range, to_utc
from jornada.operators import flatten
from jornada.operators.listing import list_entity
from jornada.session import use_utc
from jornada.sources.day_index import STARTS, landed_days
from jornada.sources.landing import last_extract, read_landing, with_company_id


def listable(raw: DataFrame, entity: str, *extra: Column, accounts: DataFrame | None = None) -> DataFrame:
    """Flat records with the columns that the entity's listing filters on, and ``extra`` ones."""

    def moment(path: str, name: str):
        return to_utc(F.col(path)).alias(name)

    if entity == "employees":
        memberships = F.col("departmentIds").alias("department_ids"), F.col("officeIds").alias("office_ids")
        return flatten.flatten_employees(raw, *memberships, *extra)
    if entity == "work_entries":
        moments = (
            moment("workEntryIn.date", "work_entry_in"),
            moment("updatedAt", "updated_at"),
            moment("deletedAt", "deleted_at"),
        )
        return flatten.flatten_work_entries(raw, *moments, *extra)[0]
    if entity == "time_entries":
        return flatten.flatten_time_entries(raw, moment("timeEntryIn.date", "time_entry_in"), *extra)
    if entity == "projects":
        return flatten.flatten_projects(with_company_id(raw, accounts), F.col("company_id"), *extra)
    if entity == "department_assignments":
        return flatten.flatten_department_assignments(raw, *extra)
    if entity == "departments":
        return flatten.flatten_departments(raw, *extra)
    return raw


def list_landing(
    spark: SparkSession,
    root: str,
    entity: str,
    tenants: Iterable[str] | None = None,
    index: str | None = None,
    **asked,
) -> DataFrame:
    """Filter, order and page an entity's landed records, each in its last extract.

    See ``LISTINGS`` for the parameters. With the folder of a day ``index``, a
    listing of entries between two days reads only the days on which one of
    their versions was landed.
    """
    use_utc(spark)
    if entity == "worked_hours":
        # These records have no id; and only here the folder's date is the day that is asked for.
        days = {k: asked.get(k) for k in ("from_date", "to_date")}
        worked = read_landing(spark, root, entity, tenants, last_only=True, **days).drop("extract")
        return list_entity(worked, entity, **asked)

    days = None
    if index is not None and entity in STARTS and (asked.get("from_date") or asked.get("to_date")):
        between = check_date_range(asked.get("from_date") or "0001-01-01", asked.get("to_date") or "9999-12-30")
        days = landed_days(spark, root, index, entity, *between)

    def last(name: str, accounts: DataFrame | None = None) -> DataFrame:
        on_days = days if name == entity else None
        raw = read_landing(spark, root, name, tenants, with_arrival=True, on_days=on_days)
        return last_extract(listable(raw, name, F.col("arrival"), accounts=accounts))

    accounts = read_landing(spark, root, "account") if entity == "projects" else None
    people = last("employees") if entity == "time_entries" else None
    return list_entity(last(entity, accounts), entity, employees=people, **asked)
