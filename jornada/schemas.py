"""Declared schemas of the landing records, the warehouse and the marts.

Nothing is inferred: codes that look numeric (postal code, national id, phone)
stay strings, so leading zeros survive.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StructField, StructType

# Field names of the nested landing records.
LANDING = {
    "employees": """
        id string, firstName string, lastName string, email string, workStatus string,
        imageProfileURL string, code string, pin string, phone string,
        company struct<id: string, name: string>, gender string, contractId string,
        nid string, identityNumberType string, ssn string, pricePerHour double,
        accountNumber string, dateOfBirth string,
        customFields array<struct<slug: string, value: string>>,
        status string, children int, disability double, address string, postalCode string,
        city string, province string, country string, nationality string,
        maritalStatus string, salaryRange string, studyLevel string,
        professionalCategoryCode string, professionalCategoryDescription string,
        bic string, jobChargeId string, jobChargeName string,
        departmentIds array<string>, officeIds array<string>""",
    "worked_hours": """
        employeeId string, secondsWorked bigint, secondsToWork bigint, secondsBalance bigint,
        checks array<struct<checkIn: string, checkOut: string, secondsWorked: bigint>>""",
    "work_entries": """
        id string, employee struct<id: string>, workEntryType string, workedSeconds bigint,
        workEntryIn struct<date: string>, workEntryOut struct<date: string>,
        workBreakId string, updatedAt string, deletedAt string""",
    "time_entries": """
        id string, employee struct<id: string>, project struct<id: string>,
        timeEntryIn struct<date: string>, timeEntryOut struct<date: string>,
        tags struct<data: array<struct<name: string>>>, comment string""",
    "department_assignments": """
        id string,
        employee struct<id: string, company: struct<id: string, name: string>>,
        department struct<id: string, name: string>, createdAt string, updatedAt string""",
    "projects": """
        id string, name string, customer struct<id: string, customerName: string>,
        price double, projectStatus struct<value: string>, externalProjectId string""",
    "departments": "id string, name string",
    "account": "company struct<id: string>",
    "boards": "id string, workspace_id string, name string",
    "board_items": "board_id string, cursor string, items array<struct<id: string, name: string>>",
    "item_cells": """
        id string,
        column_values array<struct<column: struct<id: string, title: string>, value: string>>""",
}

# Column names and order of the warehouse and mart tables.
WAREHOUSE = {
    "dim_employee": """
        empleado_id bigint, empleado_sesame_id string, nombre string, apellidos string, email string,
        telefono string, telefono_corto string, empresa_sesame_id string, sexo string,
        contrato_sesame_id string, nid string, ssn string, costo_hora double,
        fecha_nacimiento date, area string, costo_hora_empresa double, fecha_alta date,
        nucleo_negocio string, estudios string, estado string, num_hijos int,
        porcentaje_discapacidad double, direccion string, codigo_postal string,
        ciudad string, provincia string, pais string, nacionalidad string,
        estatus_marital string, nivel_estudio string, codigo_categoria_profesional string,
        categoria_profesional string, bic string, cargo_trabajo_sesame_id string,
        cargo_trabajo string, empresa_id int, tipo_nid string, numero_cuenta string,
        rango_salarial string, fecha_baja date""",
    "dim_company": "empresa_id int, empresa_sesame_id string, nombre string",
    "dim_department": "department_sesame_id string, department_name string",
    "dim_departamento": "departamento_id int, nombre string",
    "fact_department_assignment": """
        department_assignation_sesame_id string, employee_sesame_id string,
        department_sesame_id string, creation_date timestamp, update_date timestamp""",
    "dim_project": """
        project_sesame_id string, project_name string, customer_sesame_id string,
        customer_name string, project_status string""",
    "fact_time_entry": """
        time_entry_sesame_id string, project_sesame_id string, time_entry_in timestamp,
        time_entry_out timestamp, tags string, comment string, employee_sesame_id string""",
    "fact_worked_hours": """
        worked_hours_id bigint, employee_sesame_id string, date date,
        worked_time bigint, to_work_time bigint""",
    "fact_time_charge": """
        fecha date, tarea string, cliente string, proyecto string, etiqueta string,
        precio_hora double, horas_imputadas double, empresa_id int, departamento_id int,
        empleado_id bigint""",
    "fact_signing": """
        fecha date, tiempo_teorico double, tiempo_trabajado double, empresa_id int,
        departamento_id int, empleado_id bigint""",
    "mart_time_entry": """
        imputacion_id string, empleado_id string, nombres string, apellidos string,
        nombre_departamento string, fecha date, year int, mes int, nombre_cliente string,
        id_cliente string, nombre_proyecto string, id_proyecto string, etiquetas string,
        hora_inicio string, hora_fin string, costo_hora_empresa double,
        horas_imputadas double""",
    "mart_worked_hours": """
        fichaje_diario_id bigint, empleado_id string, nombres string, apellidos string,
        fecha date, tiempo_teorico double, tiempo_trabajado double""",
}

# Custom-field slug -> flat column.
EMPLOYEE_SLUGS = {
    "cf_work_phone": "cf_work_phone",
    "cf_rea": "cf_area",
    "cf_precioh_empresa": "cf_precio_hora_empresa",
    "cf_fecha_de_alta": "cf_fecha_de_alta",
    "cf_nucleo_de_negocio": "cf_nucleo_de_negocio",
    "ccf_studies": "cf_studies",
    "cf_telefono_corto": "cf_telefono_corto",
    "cf_fecha_de_baja": "cf_fecha_de_baja",
}

# Department id of people without a known department, the texts
# of a missing tag and a missing department, the required fields of a new employee.
DEFAULT_DEPARTMENT_ID = 35
MISSING_TAG = "No especificada"
MISSING_DEPARTMENT = "No asignado"
REQUIRED_EMPLOYEE_FIELDS = ("companyId", "firstName", "lastName", "email", "nid")

# Ids of the two board columns that carry hours and assignee.
BOARD_HOURS_COLUMN = "n_meros8__1"
BOARD_ASSIGNMENT_COLUMN = "asignado__1"


def landing_schema(entity: str) -> StructType:
    return StructType.fromDDL(LANDING[entity])


def envelope_schema(entity: str) -> StructType:
    """One landing page: ``{"data": [record, ...]}``."""
    return StructType([StructField("data", ArrayType(landing_schema(entity)))])


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(WAREHOUSE[name])
