"""Nested landing records -> flat rows, one function per entity.

All expressions are row-local: no shuffle. ``extra`` columns over the raw record
are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.functions import blank_if_null, custom_field, tag_names
from jornada.operators.quality import reject_missing
from jornada.schemas import EMPLOYEE_SLUGS

# Flat employee column -> path in the landing record, in output
# order; the custom-field columns stand between the two groups.
_EMPLOYEE_FIELDS_BEFORE = {
    "id": "id",
    "firstName": "firstName",
    "lastName": "lastName",
    "email": "email",
    "work_status": "workStatus",
    "profile_image_url": "imageProfileURL",
    "code": "code",
    "pin": "pin",
    "phone": "phone",
    "company_id": "company.id",
    "company_name": "company.name",
    "gender": "gender",
    "contract_id": "contractId",
    "nid": "nid",
    "identity_number_type": "identityNumberType",
    "ssn": "ssn",
    "price_per_hour": "pricePerHour",
    "account_number": "accountNumber",
    "date_of_birth": "dateOfBirth",
}
_EMPLOYEE_FIELDS_AFTER = {
    "status": "status",
    "children": "children",
    "disability": "disability",
    "address": "address",
    "postal_code": "postalCode",
    "city": "city",
    "province": "province",
    "country": "country",
    "nationality": "nationality",
    "marital_status": "maritalStatus",
    "salary_range": "salaryRange",
    "study_level": "studyLevel",
    "professional_category_code": "professionalCategoryCode",
    "professional_category_description": "professionalCategoryDescription",
    "bic": "bic",
    "job_charge_id": "jobChargeId",
    "job_charge_name": "jobChargeName",
}


def flatten_employees(raw: DataFrame, *extra: Column) -> DataFrame:
    def plain(fields):
        return [F.col(path).alias(name) for name, path in fields.items()]

    slugs = [custom_field(F.col("customFields"), slug).alias(name) for slug, name in EMPLOYEE_SLUGS.items()]
    return raw.select(*plain(_EMPLOYEE_FIELDS_BEFORE), *slugs, *plain(_EMPLOYEE_FIELDS_AFTER), *extra)


def flatten_work_entries(raw: DataFrame, *extra: Column) -> tuple[DataFrame, DataFrame]:
    """Flat clock records, and the raw records without employee, in or out."""
    valid, rejected = reject_missing(raw, ["employee", "workEntryIn", "workEntryOut"])
    flat = valid.select(
        "id",
        F.col("employee.id").alias("employee_id"),
        F.col("workEntryType").alias("work_entry_type"),
        F.col("workedSeconds").alias("worked_seconds"),
        F.col("workEntryIn.date").alias("work_entry_in_datetime"),
        F.col("workEntryOut.date").alias("work_entry_out_datetime"),
        F.col("workBreakId").alias("work_break_id"),
        *extra,
    )
    return flat, rejected


def flatten_time_entries(raw: DataFrame, *extra: Column) -> DataFrame:
    return raw.select(
        "id",
        F.col("employee.id").alias("employee_id"),
        blank_if_null(F.col("project.id")).alias("project_id"),
        F.col("timeEntryIn.date").alias("time_entry_in_datetime"),
        F.col("timeEntryOut.date").alias("time_entry_out_datetime"),
        tag_names(F.col("tags.data")).alias("tags"),
        "comment",
        *extra,
    )


def flatten_department_assignments(raw: DataFrame, *extra: Column) -> DataFrame:
    return raw.select(
        "id",
        F.col("employee.id").alias("employee_id"),
        F.col("department.id").alias("department_id"),
        F.col("department.name").alias("department_name"),
        F.col("employee.company.id").alias("company_id"),
        F.col("employee.company.name").alias("company_name"),
        F.col("createdAt").alias("created_at"),
        F.col("updatedAt").alias("updated_at"),
        *extra,
    )


def flatten_projects(raw: DataFrame, *extra: Column) -> DataFrame:
    return raw.select(
        "id",
        "name",
        blank_if_null(F.col("customer.id")).alias("customer_id"),
        blank_if_null(F.col("customer.customerName")).alias("customer_name"),
        "price",
        F.col("projectStatus.value").alias("project_status"),
        F.col("externalProjectId").alias("external_project_id"),
        *extra,
    )


def flatten_departments(raw: DataFrame, *extra: Column) -> DataFrame:
    return raw.select("id", "name", *extra)
