from datetime import date

from conftest import rows

from jornada.functions import day_spine
from jornada.operators.daily import daily_worked_hours, missing_days, worked_hours_with_checks
from jornada.operators.latest import last_id_per_key, latest_per_key, latest_values

ASSIGNMENTS = [
    ("e1", "d1", date(2024, 1, 5), 1),
    ("e1", "d2", date(2024, 1, 5), 2),
    ("e1", "d0", None, 9),
    ("e2", "d3", None, 3),
]


def test_latest_ties_and_nulls(spark):
    df = spark.createDataFrame(ASSIGNMENTS, "employee string, department string, updated date, id int")
    latest = latest_per_key(df, ["employee"], "updated", "id").select("employee", "department")
    assert rows(latest) == [("e1", "d2"), ("e2", "d3")]
    assert rows(latest_values(df, ["employee"], ["department"], "updated", "id")) == [("e1", "d2"), ("e2", "d3")]


def test_last_id_skips_missing_keys(spark):
    df = spark.createDataFrame([("n1", 3), ("n1", 7), (None, 9), ("n2", None)], "nid string, id bigint")
    assert rows(last_id_per_key(df, "nid", "id")) == [("n1", 7), ("n2", None)]


def records(spark):
    d = date(2024, 1, 5)
    data = [("e1", d, 3600, "a"), ("e1", d, None, "b"), (None, d, 60, "c"), ("e2", d, None, "d"), ("e2", None, 5, "e")]
    return spark.createDataFrame(data, "employeeId string, date date, secondsWorked bigint, check string")


def test_daily_totals(spark):
    daily = daily_worked_hours(records(spark), seconds=["secondsWorked"])
    assert rows(daily) == [("e1", date(2024, 1, 5), 3600), ("e2", date(2024, 1, 5), 0)]


def test_checks_carry_the_totals(spark):
    checks = worked_hours_with_checks(records(spark), ["check"], seconds=["secondsWorked"])
    assert rows(checks.select("employeeId", "check", "secondsWorked")) == [
        ("e1", "a", 3600),
        ("e1", "b", 3600),
        ("e2", "d", 0),
    ]


def test_missing_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 1, 2),), (date(2024, 2, 1),)], "date date")
    counts = missing_days(df, day_spine(spark, date(2024, 1, 1), date(2024, 1, 3)))
    assert [r[1] for r in rows(counts)] == [0, 2, 0]
