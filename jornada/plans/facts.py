"""Flat extract rows -> warehouse fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.functions import duration_hours, first_characters, null_if_blank, to_utc
from jornada.operators.daily import daily_worked_hours
from jornada.operators.latest import last_id_per_key, latest_values
from jornada.operators.lookup import lookup_contains
from jornada.operators.quality import drop_nulls, fill_nulls
from jornada.operators.sizes import broadcast_if_small
from jornada.schemas import DEFAULT_DEPARTMENT_ID, MISSING_DEPARTMENT, MISSING_TAG, table_schema

COMMENT_LENGTH = 200


def time_entries(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("id").alias("time_entry_sesame_id"),
        F.col("project_id").alias("project_sesame_id"),
        to_utc(F.col("time_entry_in_datetime")).alias("time_entry_in"),
        to_utc(F.col("time_entry_out_datetime")).alias("time_entry_out"),
        "tags",
        first_characters(F.col("comment"), COMMENT_LENGTH).alias("comment"),
        F.col("employee_id").alias("employee_sesame_id"),
    )


def worked_hours(records: DataFrame) -> DataFrame:
    daily = daily_worked_hours(records)
    return daily.select(
        F.col("employeeId").alias("employee_sesame_id"),
        F.col("date").cast("date").alias("date"),
        F.col("secondsWorked").alias("worked_time"),
        F.col("secondsToWork").alias("to_work_time"),
    )


def charge_profiles(
    employees: DataFrame,
    warehouse_ids: DataFrame,
    companies: DataFrame,
    assignments: DataFrame,
    departments: DataFrame,
    company_aliases: Sequence[tuple[str, object]] = (),
    missing_department: str | None = None,
) -> DataFrame:
    """One row per employee with everything a charge or signing needs of them.

    All lookups run on the employee table, so that a fact row is joined once,
    by employee, whatever the number of lookups.
    """
    by_nid = last_id_per_key(warehouse_ids, "nid", "empleado_id").withColumnRenamed("nid", "known_nid")
    current = latest_values(
        assignments.withColumn("_updated", to_utc(F.col("updated_at"))),
        keys=["employee_id"],
        values=["department_name"],
        updated_at="_updated",
        tie_break="id",
    ).withColumnRenamed("employee_id", "id")
    # Null-safe joins here and below, although neither right side has null keys:
    # both sides then get an exchange of their own, and AQE can split a hot key.
    known = employees.where("id is not null").select(
        "id", "nid", F.col("company_name").alias("cliente"), "price_per_hour"
    )
    people = known.join(by_nid, F.col("nid").eqNullSafe(F.col("known_nid")), "left").join(current, "id", "left")
    if missing_department is not None:
        people = fill_nulls(people, {"department_name": missing_department})
    people = lookup_contains(
        people, "cliente", companies, "nombre", "empresa_id", "empresa_id", "empresa_id", aliases=company_aliases
    )
    profiles = lookup_contains(
        people,
        "department_name",
        departments,
        "nombre",
        "departamento_id",
        "departamento_id",
        "departamento_id",
        default=DEFAULT_DEPARTMENT_ID,
    )
    inputs = (
        known,
        warehouse_ids.select("nid", "empleado_id"),
        assignments.select("employee_id", "department_name"),
    )
    return broadcast_if_small(profiles, *inputs)


def time_charges(flat_entries: DataFrame, profiles: DataFrame) -> DataFrame:
    """Charged hours of employees known to the warehouse.

    Entries without tags get a label; rows that are otherwise incomplete, such as
    those without project, are dropped.
    """
    start, end = to_utc(F.col("time_entry_in_datetime")), to_utc(F.col("time_entry_out_datetime"))
    entries = flat_entries.select(
        F.to_date(start).alias("fecha"),
        F.col("comment").alias("tarea"),
        null_if_blank(F.col("project_id")).alias("proyecto"),
        null_if_blank(F.col("tags")).alias("etiqueta"),
        duration_hours(start, end).alias("horas_imputadas"),
        "employee_id",
    )
    known = profiles.where(F.col("empleado_id").isNotNull()).withColumnRenamed("price_per_hour", "precio_hora")
    columns = table_schema("fact_time_charge").names
    charges = entries.join(known, F.col("employee_id").eqNullSafe(F.col("id"))).select(*columns)
    return drop_nulls(fill_nulls(charges, {"tarea": "", "etiqueta": MISSING_TAG}))


def signings(records: DataFrame, profiles: DataFrame) -> DataFrame:
    """Seconds to work and worked per day, of employees with known ids."""
    daily = daily_worked_hours(records).withColumnRenamed("employeeId", "id")
    joined = daily.join(profiles, "id", "left").select(
        F.col("date").cast("date").alias("fecha"),
        F.col("secondsToWork").cast("double").alias("tiempo_teorico"),
        F.col("secondsWorked").cast("double").alias("tiempo_trabajado"),
        "empresa_id",
        "departamento_id",
        "empleado_id",
    )
    return drop_nulls(drop_nulls(joined, ["empresa_id", "departamento_id", "empleado_id"]))


def signing_profiles(*args, **kwargs) -> DataFrame:
    return charge_profiles(*args, missing_department=MISSING_DEPARTMENT, **kwargs)
