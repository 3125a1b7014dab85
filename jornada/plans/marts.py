"""Warehouse tables -> denormalised data-mart rows.

A dimension is broadcast only within Spark's size limit. Beyond that it is
joined by shuffle, where AQE splits a hot employee or project over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.functions import check_date_range, duration_hours, hour_minute, in_date_range, seconds_to_hours
from jornada.operators.latest import latest_values
from jornada.operators.sizes import broadcast_if_small


def latest_departments(assignments: DataFrame, departments: DataFrame) -> DataFrame:
    """Department name of each employee's latest assignment."""
    latest = latest_values(
        assignments,
        keys=["employee_sesame_id"],
        values=["department_sesame_id"],
        updated_at="update_date",
        tie_break="department_assignation_sesame_id",
    )
    return latest.join(
        departments.select("department_sesame_id", "department_name"), "department_sesame_id", "left"
    ).select("employee_sesame_id", "department_name")


def employee_profiles(employees: DataFrame, assignments: DataFrame, departments: DataFrame) -> DataFrame:
    """All that the mart needs per employee id, of the dimension or assigned only.

    Joining the two employee-keyed tables first leaves the fact one join by
    employee instead of two.
    """
    people = employees.select(
        F.col("empleado_sesame_id").alias("empleado_id"),
        F.col("nombre").alias("nombres"),
        "apellidos",
        "costo_hora_empresa",
    )
    assigned = latest_departments(assignments, departments)
    both = people.join(assigned, people["empleado_id"] == assigned["employee_sesame_id"], "full_outer")
    profiles = both.select(
        F.coalesce("empleado_id", "employee_sesame_id").alias("employee_sesame_id"),
        "empleado_id",
        "nombres",
        "apellidos",
        "costo_hora_empresa",
        F.col("department_name").alias("nombre_departamento"),
    )
    assigned_columns = assignments.select("employee_sesame_id", "department_sesame_id")
    return broadcast_if_small(profiles, people, assigned_columns, departments)


def mart_time_entries(
    entries: DataFrame,
    projects: DataFrame,
    employees: DataFrame,
    assignments: DataFrame,
    departments: DataFrame,
    from_date: str,
    to_date: str,
) -> DataFrame:
    """Entries that start in the range, with project, employee and department."""
    chosen = in_date_range(entries, "time_entry_in", *check_date_range(from_date, to_date))
    clients = projects.select("project_sesame_id", "project_name", "customer_sesame_id", "customer_name")
    people = employee_profiles(employees, assignments, departments)
    joined = chosen.join(people, "employee_sesame_id", "left").join(clients, "project_sesame_id", "left")
    start, end = F.col("time_entry_in"), F.col("time_entry_out")
    return joined.select(
        F.col("time_entry_sesame_id").alias("imputacion_id"),
        "empleado_id",
        "nombres",
        "apellidos",
        "nombre_departamento",
        F.to_date(start).alias("fecha"),
        F.year(start).alias("year"),
        F.month(start).alias("mes"),
        F.col("customer_name").alias("nombre_cliente"),
        F.col("customer_sesame_id").alias("id_cliente"),
        F.col("project_name").alias("nombre_proyecto"),
        F.col("project_sesame_id").alias("id_proyecto"),
        F.col("tags").alias("etiquetas"),
        hour_minute(start).alias("hora_inicio"),
        hour_minute(end).alias("hora_fin"),
        "costo_hora_empresa",
        duration_hours(start, end).alias("horas_imputadas"),
    )


def mart_worked_hours(worked: DataFrame, employees: DataFrame, from_date: str, to_date: str) -> DataFrame:
    """Daily hours in the range with the employee's name; unknown employees stay."""
    chosen = in_date_range(worked, "date", *check_date_range(from_date, to_date))
    people = employees.select("empleado_sesame_id", F.col("nombre").alias("nombres"), "apellidos")
    joined = chosen.join(people, chosen["employee_sesame_id"] == people["empleado_sesame_id"], "left")
    return joined.select(
        F.col("worked_hours_id").alias("fichaje_diario_id"),
        F.col("employee_sesame_id").alias("empleado_id"),
        "nombres",
        "apellidos",
        F.col("date").alias("fecha"),
        seconds_to_hours(F.col("to_work_time")).alias("tiempo_teorico"),
        seconds_to_hours(F.col("worked_time")).alias("tiempo_trabajado"),
    )
