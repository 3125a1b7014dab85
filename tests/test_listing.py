from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from jornada.operators import listing


@pytest.fixture(scope="module")
def people(spark):
    data = [(i, f"n{i % 7}", "active" if i % 3 else "inactive", [f"d{i % 2}", "all"]) for i in range(50)]
    return spark.createDataFrame(data, "id int, name string, status string, department_ids array<string>")


def test_none_is_no_filter(people):
    assert listing.list_entity(people, "employees", email=None, status=None).count() == 50


def test_equal_and_any_of(people):
    chosen = listing.list_entity(people, "employees", status="inactive", department_ids=["d1", "d9"])
    assert [r.id for r in chosen.orderBy("id").collect()] == [i for i in range(50) if i % 3 == 0 and i % 2]


def test_any_of_long_and_odd_lists(spark, people):
    many = [f"x{i}" for i in range(20_000)] + ["d1"]
    assert listing.any_of(people, "department_ids", many).count() == 25
    assert listing.any_of(people, "department_ids", [None, "it's \"d0\""]).count() == 0
    assert listing.any_of(people, "department_ids", []).count() == 0
    numbers = spark.createDataFrame([(1, [1, 2]), (2, [3]), (3, []), (4, None), (5, [None])], "id int, offices array<long>")
    assert [r.id for r in listing.any_of(numbers, "offices", ["2", 3, "two", None]).orderBy("id").collect()] == [1, 2]
    assert listing.any_of(numbers, "offices", ["two"]).count() == 0


def test_unknown_parameter(people):
    with pytest.raises(ValueError):
        listing.list_entity(people, "departments", status="active")


def test_pages_cover_the_table_in_order(people):
    expected = [r[0] for r in sorted(((i, f"n{i % 7}") for i in range(50)), key=lambda r: (-int(r[1][1:]), r[0]))]
    for top_rows in (1000, 0):
        got = []
        for page in range(1, 8):
            part = listing.page_of(people, "name desc", 8, page, tie_break=["id"], top_rows=top_rows)
            got += [r.id for r in part.collect()]
        assert got == expected


def test_page_past_the_end_is_empty(people):
    for top_rows in (1000, 0):
        assert listing.page_of(people, "id", 10, 9, top_rows=top_rows).isEmpty()


def test_page_without_limit_has_the_usual_size(spark):
    df = spark.range(250).withColumn("name", F.lit("n"))
    assert [r.id for r in listing.list_entity(df, "departments", page=3).collect()] == list(range(200, 250))
    assert listing.list_entity(df, "departments").count() == 250


def test_nulls_come_last_both_ways(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "id int")
    assert [r.id for r in listing.page_of(df, "id asc", 3).collect()] == [1, 2, None]
    assert [r.id for r in listing.page_of(df, "id desc", 3).collect()] == [2, 1, None]


@pytest.mark.parametrize("limit,page", [(0, 1), (5, 0)])
def test_pages_start_at_one(people, limit, page):
    with pytest.raises(ValueError):
        listing.page_of(people, "id", limit, page)


def test_long_value_lists_are_joined(spark):
    df = spark.range(5000)
    wanted = list(range(0, 4000, 2))
    assert listing.one_of(df, "id", wanted).count() == 2000
    assert listing.one_of(df, "id", wanted[:10]).count() == 10
    assert listing.one_of(df, "id", []).count() == 0


@pytest.fixture(scope="module")
def entries(spark):
    data = [
        (i, f"e{i % 3}", datetime(2024, 1, 1 + i), datetime(2024, 1, 5 + i), datetime(2024, 2, 1) if i % 4 == 0 else None)
        for i in range(20)
    ]
    return spark.createDataFrame(
        data, "id int, employee_id string, work_entry_in timestamp, updated_at timestamp, deleted_at timestamp"
    )


def ids(df):
    return [r.id for r in df.orderBy("id").collect()]


def test_deleted_filter(entries):
    def ask(**how):
        return listing.list_entity(entries, "work_entries", **how).count()

    assert (ask(), ask(only_return="not_deleted"), ask(only_return="deleted"), ask(only_return="all")) == (15, 15, 5, 20)
    with pytest.raises(ValueError):
        ask(only_return="some")


def test_dates_and_updates(entries):
    chosen = listing.list_entity(
        entries,
        "work_entries",
        from_date="2024-01-03",
        to_date="2024-01-10",
        updated_at_gte="2024-01-08 00:00:00",
        updated_at_lte="2024-01-12",
        only_return="all",
    )
    assert ids(chosen) == [3, 4, 5, 6, 7]
    half_open = listing.list_entity(entries, "work_entries", from_date="2024-01-18", only_return="all")
    assert ids(half_open) == [17, 18, 19]


def test_worked_hours_need_a_range(spark):
    df = spark.createDataFrame([("e1", datetime(2024, 1, 1).date(), [1])], "employeeId string, date date, checks array<int>")
    with pytest.raises(ValueError):
        listing.list_entity(df, "worked_hours", from_date="2024-01-01")
    dates = {"from_date": "2024-01-01", "to_date": "2024-01-01"}
    assert "checks" not in listing.list_entity(df, "worked_hours", **dates).columns
    assert "checks" in listing.list_entity(df, "worked_hours", with_checks=True, **dates).columns


def test_entries_of_active_employees_by_default(entries, spark):
    staff = spark.createDataFrame([("e0", "active"), ("e1", "inactive")], "id string, status string")
    timed = entries.withColumnRenamed("work_entry_in", "time_entry_in")
    chosen = listing.list_entity(timed, "time_entries", employees=staff)
    assert {r.employee_id for r in chosen.collect()} == {"e0"}
    chosen = listing.list_entity(timed, "time_entries", employees=staff, employee_status="inactive")
    assert {r.employee_id for r in chosen.collect()} == {"e1"}


def test_point_read_and_statuses(people):
    assert rows(listing.by_id(people.select("id"), "id", 7)) == [(7,)]
    both = listing.with_statuses(people, ["active", "inactive"])
    assert both.count() == 50 and both.where(F.col("status") == "inactive").count() == 17


@pytest.mark.parametrize("more", [0, 1000])
def test_lists_of_any_length_take_text(spark, more):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id bigint")
    values = ["1", 3, None, "x", *[str(10 + i) for i in range(more)]]
    assert rows(listing.one_of(df, "id", values)) == [(1,), (3,)]
    assert listing.one_of(df, "id", []).count() == 0


def test_employee_status_needs_employees(spark):
    df = spark.createDataFrame([("e1", datetime(2024, 1, 1))], "employee_id string, time_entry_in timestamp")
    with pytest.raises(ValueError):
        listing.list_entity(df, "time_entries", employee_status="inactive")
