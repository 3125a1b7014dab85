"""Flat extract rows -> warehouse dimension and assignment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.functions import day_first_date, decimal_comma, iso_date, to_utc, zero_if_null
from jornada.functions.parse import parsed_day_first, parsed_decimal, parsed_iso_date
from jornada.operators.lookup import lookup_contains
from jornada.operators.quality import reject_missing
from jornada.schemas import table_schema

# Given out by the load, not by the extract.
EMPLOYEE_SURROGATE = "empleado_id"


def departments(flat: DataFrame) -> DataFrame:
    return flat.select(F.col("id").alias("department_sesame_id"), F.col("name").alias("department_name"))


def department_assignments(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("id").alias("department_assignation_sesame_id"),
        F.col("employee_id").alias("employee_sesame_id"),
        F.col("department_id").alias("department_sesame_id"),
        to_utc(F.col("created_at")).alias("creation_date"),
        to_utc(F.col("updated_at")).alias("update_date"),
    )


def projects(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("id").alias("project_sesame_id"),
        F.col("name").alias("project_name"),
        F.col("customer_id").alias("customer_sesame_id"),
        "customer_name",
        "project_status",
    )


# Employee column -> flat column, by rule.
_COPIED = {
    "empleado_sesame_id": "id",
    "nombre": "firstName",
    "apellidos": "lastName",
    "email": "email",
    "telefono": "phone",
    "telefono_corto": "cf_telefono_corto",
    "empresa_sesame_id": "company_id",
}
_BLANK_IF_NULL = {
    "sexo": "gender",
    "contrato_sesame_id": "contract_id",
    "nid": "nid",
    "ssn": "ssn",
    "area": "cf_area",
    "nucleo_negocio": "cf_nucleo_de_negocio",
    "estudios": "cf_studies",
    "estado": "status",
    "direccion": "address",
    "codigo_postal": "postal_code",
    "ciudad": "city",
    "provincia": "province",
    "pais": "country",
    "nacionalidad": "nationality",
    "estatus_marital": "marital_status",
    "nivel_estudio": "study_level",
    "codigo_categoria_profesional": "professional_category_code",
    "categoria_profesional": "professional_category_description",
    "bic": "bic",
    "cargo_trabajo_sesame_id": "job_charge_id",
    "cargo_trabajo": "job_charge_name",
    "tipo_nid": "identity_number_type",
    "numero_cuenta": "account_number",
    "rango_salarial": "salary_range",
}


def employee_rules() -> dict[str, Column]:
    """Target column -> expression over the flat employee row, before nulls become blank."""
    rules = {name: F.col(source) for name, source in _COPIED.items()}
    rules |= {name: F.col(source) for name, source in _BLANK_IF_NULL.items()}
    return rules | {
        "costo_hora": zero_if_null(F.col("price_per_hour"), "double"),
        "num_hijos": zero_if_null(F.col("children"), "int"),
        "porcentaje_discapacidad": zero_if_null(F.col("disability"), "double"),
        "costo_hora_empresa": decimal_comma(F.col("cf_precio_hora_empresa")),
        "fecha_nacimiento": iso_date(F.col("date_of_birth")),
        "fecha_alta": day_first_date(F.col("cf_fecha_de_alta")),
        "fecha_baja": day_first_date(F.col("cf_fecha_de_baja")),
    }


def employee_parses() -> dict[str, tuple[Column, Column]]:
    """Texts of a flat employee row that must be readable, if there are any."""
    texts = {
        "cf_precio_hora_empresa": parsed_decimal,
        "date_of_birth": parsed_iso_date,
        "cf_fecha_de_alta": parsed_day_first,
        "cf_fecha_de_baja": parsed_day_first,
    }
    return {name: (F.col(name), rule(F.col(name))) for name, rule in texts.items()}


def employees(flat: DataFrame, companies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Employee dimension rows, and the rows whose company is unknown."""
    cleaned = flat.select(*[rule.alias(name) for name, rule in employee_rules().items()])
    cleaned = cleaned.na.fill("", subset=list(_BLANK_IF_NULL))
    resolved = lookup_contains(
        cleaned,
        field="empresa_sesame_id",
        dim=companies,
        needle="empresa_sesame_id",
        id_column="empresa_id",
        rank="empresa_id",
        out="empresa_id",
    ).select(*[c for c in table_schema("dim_employee").names if c != EMPLOYEE_SURROGATE])
    return reject_missing(resolved, ["empresa_id"])
