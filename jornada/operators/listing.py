"""Listing queries: optional filters, order, limit and page."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.functions import check_date_range, in_date_range, parse_order
from jornada.operators.positions import PositionIndex

# Fixed value: rows of a page when a page but no limit is asked for.
PAGE_SIZE = 100

# Longer value lists are joined instead of written into the plan.
MAX_IN_LIST = 1000
# Pages that end within this many rows are taken by a top-k; later ones by position.
# The top-k brings this many rows of every task together, so the bound is low.
TOP_ROWS = 1_000


def equal_to(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Equality per column; a filter of None is no filter."""
    for column, value in filters.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def one_of(df: DataFrame, column: str, values: Sequence | DataFrame | None) -> DataFrame:
    """Column in a list, or in the one column of a DataFrame.

    Listed values are taken as text and read as the column's type, however many
    they are; one that cannot be read so matches nothing, and neither does None.
    """
    if values is None:
        return df
    if not isinstance(values, DataFrame):
        kind = df.schema[column].dataType
        texts = [str(v) for v in values if v is not None]
        if len(texts) <= MAX_IN_LIST:
            return df.where(F.col(column).isin([F.lit(v).try_cast(kind) for v in texts]) if texts else F.lit(False))
        listed = F.explode(F.from_json(F.lit(json.dumps(texts)), "array<string>"))
        values = df.sparkSession.range(1).select(listed.alias("value"))
        values = values.select(F.col("value").try_cast(kind).alias(column))
    return df.join(values.toDF(column), column, "left_semi")


def any_of(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Array column that shares a value with the list.

    The list is one literal, however long it is. Its values are taken as text
    and read as the type of the array's elements; one that cannot be read so
    matches nothing, and neither does None.
    """
    if values is None:
        return df
    texts = [str(v) for v in values if v is not None]
    listed = F.from_json(F.lit(json.dumps(texts)), "array<string>")
    kind = df.schema[column].dataType.elementType
    if kind.simpleString() != "string":
        listed = F.filter(F.transform(listed, lambda v: v.try_cast(kind)), lambda v: v.isNotNull())
    return df.where(F.arrays_overlap(F.col(column), listed))


def changed_between(df: DataFrame, column: str, at_least: str | None = None, at_most: str | None = None) -> DataFrame:
    kind = df.schema[column].dataType
    if at_least is not None:
        df = df.where(F.col(column) >= F.lit(at_least).cast(kind))
    if at_most is not None:
        df = df.where(F.col(column) <= F.lit(at_most).cast(kind))
    return df


def soft_deleted(df: DataFrame, only_return: str | None = None, column: str = "deleted_at") -> DataFrame:
    """``not_deleted`` (also the default), ``deleted`` or ``all``."""
    if only_return in (None, "not_deleted"):
        return df.where(F.col(column).isNull())
    if only_return == "deleted":
        return df.where(F.col(column).isNotNull())
    if only_return == "all":
        return df
    raise ValueError(f"only_return must be all, not_deleted or deleted, not {only_return!r}")


def of_employees_with_status(
    df: DataFrame,
    employees: DataFrame,
    status: str | None = "active",
    key: str = "employee_id",
    employee_key: str = "id",
    status_column: str = "status",
) -> DataFrame:
    """Rows of employees with this status; None means active."""
    chosen = employees.where(F.col(status_column) == (status or "active")).select(F.col(employee_key).alias(key))
    return df.join(chosen, key, "left_semi")


def page_of(
    df: DataFrame,
    order_by: str,
    limit: int,
    page: int = 1,
    tie_break: Sequence[str] = (),
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Page ``page`` (from 1) of ``limit`` rows; the tie-break columns make the order total.

    Early pages are a top-k: each task keeps its first rows only. A page far
    down would push everything before it through one task; it is found through
    a ``PositionIndex``, which is made for it and removed. For several pages of
    one listing make the index once and ask it.
    """
    if limit < 1 or page < 1:
        raise ValueError("limit and page start at 1")
    order = parse_order(order_by, df.columns)
    order += [F.col(c).asc_nulls_last() for c in tie_break]
    first = (page - 1) * limit
    if first + limit <= top_rows:
        return df.orderBy(*order).offset(first).limit(limit)
    with PositionIndex(df, order_by, tie_break) as index:
        return index.page(limit, page)


@dataclass(frozen=True)
class Listing:
    """Which filters an entity's listing takes: parameter -> column."""

    equal: Mapping[str, str] = field(default_factory=dict)
    any_of: Mapping[str, str] = field(default_factory=dict)
    one_of: Mapping[str, str] = field(default_factory=dict)
    day: str | None = None
    day_required: bool = False
    updated: str | None = None
    deleted: str | None = None
    employee_status: bool = False
    with_checks: bool = False
    orders: bool = False
    key: Sequence[str] = ("id",)

    def parameters(self) -> set[str]:
        names = {*self.equal, *self.any_of, *self.one_of, "limit", "page"}
        if self.day:
            names |= {"from_date", "to_date"}
        if self.updated:
            names |= {"updated_at_gte", "updated_at_lte"}
        for on, name in (
            (self.deleted, "only_return"),
            (self.employee_status, "employee_status"),
            (self.with_checks, "with_checks"),
            (self.orders, "order_by"),
        ):
            if on:
                names.add(name)
        return names


# The filters of each listing.
LISTINGS = {
    "employees": Listing(
        equal={"code": "code", "dni": "nid", "email": "email", "status": "status"},
        any_of={"department_ids": "department_ids", "office_ids": "office_ids"},
        orders=True,
    ),
    "worked_hours": Listing(
        one_of={"employee_ids": "employeeId"},
        day="date",
        day_required=True,
        with_checks=True,
        key=("employeeId", "date"),
    ),
    "work_entries": Listing(
        equal={"employee_id": "employee_id"},
        day="work_entry_in",
        updated="updated_at",
        deleted="deleted_at",
        orders=True,
    ),
    "time_entries": Listing(equal={"employee_id": "employee_id"}, day="time_entry_in", employee_status=True),
    "department_assignments": Listing(equal={"employee_id": "employee_id", "department_id": "department_id"}),
    "projects": Listing(equal={"company_id": "company_id"}, orders=True),
    "departments": Listing(equal={"name": "name"}, orders=True),
}


def list_entity(df: DataFrame, entity: str, employees: DataFrame | None = None, **asked) -> DataFrame:
    """Listing of one entity; parameters left out, or None, do not filter.

    Without ``limit`` and ``page`` the whole filtered table is returned.
    """
    spec = LISTINGS[entity]
    unknown = set(asked) - spec.parameters()
    if unknown:
        raise ValueError(f"{entity} has no parameter {sorted(unknown)}")
    get = asked.get
    df = equal_to(df, {column: get(name) for name, column in spec.equal.items()})
    for name, column in spec.any_of.items():
        df = any_of(df, column, get(name))
    for name, column in spec.one_of.items():
        df = one_of(df, column, get(name))
    if spec.day:
        df = _by_day(df, spec, get("from_date"), get("to_date"))
    if spec.updated:
        df = changed_between(df, spec.updated, get("updated_at_gte"), get("updated_at_lte"))
    if spec.deleted:
        df = soft_deleted(df, get("only_return"), spec.deleted)
    if spec.employee_status and employees is None and get("employee_status"):
        raise ValueError("employee_status needs the employees")
    if spec.employee_status and employees is not None:
        df = of_employees_with_status(df, employees, get("employee_status"))
    if spec.with_checks and not get("with_checks"):
        df = df.drop("checks")
    if get("limit") is None and get("page") is None:
        return df.orderBy(*parse_order(get("order_by"), df.columns)) if get("order_by") else df
    order_by = get("order_by") or ", ".join(spec.key)
    return page_of(df, order_by, get("limit") or PAGE_SIZE, get("page") or 1, tie_break=spec.key)


def _by_day(df: DataFrame, spec: Listing, from_date: str | None, to_date: str | None) -> DataFrame:
    if from_date is None and to_date is None and not spec.day_required:
        return df
    first, last = check_date_range(from_date or "0001-01-01", to_date or "9999-12-30")
    if spec.day_required and None in (from_date, to_date):
        raise ValueError("from_date and to_date are required")
    return in_date_range(df, spec.day, first, last)


def by_id(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def with_statuses(df: DataFrame, statuses: Iterable[str], column: str = "status") -> DataFrame:
    """Rows of several statuses in one scan."""
    return df.where(F.col(column).isin(list(statuses)))
