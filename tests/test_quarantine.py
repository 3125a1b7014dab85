import json
from datetime import date

import pytest
from conftest import rows
from landing_zone import employee, hours, time_entry, write_all, write_pages
from pyspark.sql import functions as F

from jornada.functions.parse import errors, parsed_day_first, parsed_decimal, parsed_iso_date, parsed_moment
from jornada.operators import flatten
from jornada.operators.latest import latest_generation
from jornada.plans import facts, jobs
from jornada.plans.audit import Audit, audited
from jornada.plans.listings import list_landing
from jornada.schemas import table_schema
from jornada.sources.landing import read_landing
from jornada.sources.quarantine import TooManyRejects, read_checked, split_once, stream_checked
from jornada.sources.tables import read_table
from jornada.streaming.incremental import correct_late_days, daily_seconds_stream, late_rows, start_daily_totals, start_incremental_load


def reasons(checked):
    told = checked.where("reject is not null").select(F.explode("reject.errors").alias("e")).select("e.*")
    return rows(told.select("field", "reason"))


def write_raw(root, entity, tenant, *lines, name="raw"):
    folder = root / entity / f"tenant={tenant}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


@pytest.fixture
def bad_employees(tmp_path):
    root = tmp_path / "landing"
    good = employee("e1", "Acme")
    write_raw(
        root,
        "employees",
        "north",
        json.dumps({"data": [good, {**good, "id": "e2", "pricePerHour": "a lot", "children": "two"}, None, 5]}),
        '{"data": [{"id": "cut',
        json.dumps({"data": []}),
        json.dumps({"data": "none"}),
        json.dumps({"message": "no rights"}),
        json.dumps({"data": [{**good, "id": "e3", "company": {"id": "x", "name": "y"}, "customFields": [{"slug": 1}]}]}),
        json.dumps({"data": [{**good, "id": "e4", "customFields": "many"}, {**good, "id": "e5", "company": None}]}),
    )
    return root


def test_every_unreadable_record_has_its_reason(spark, bad_employees):
    checked = read_checked(spark, str(bad_employees), "employees")
    assert reasons(checked) == [
        (None, "malformed page"),
        (None, "malformed page"),
        (None, "no record"),
        (None, "no record"),
        (None, "page without data"),
        ("children", "wrong type"),
        ("customFields", "wrong type"),
        ("pricePerHour", "wrong type"),
    ]
    good = checked.where("reject is null").drop("reject")
    assert [r[0] for r in rows(good.select("id"))] == ["e1", "e3", "e5"]
    # They are as the plain reader has them, which also loses good records next to a bad one.
    plain = read_landing(spark, str(bad_employees), "employees").where("id in ('e1', 'e3')")
    assert good.columns == plain.columns and rows(good.where("id = 'e3'")) == rows(plain)
    texts = {r.reject.text for r in checked.where("reject is not null").collect()}
    assert '{"data": [{"id": "cut' in texts and any('"a lot"' in (t or "") for t in texts)


def test_plain_landing_has_no_rejects(spark, tmp_path):
    root = tmp_path / "landing"
    write_all(root)
    for entity in ("employees", "time_entries", "worked_hours", "departments", "projects", "department_assignments"):
        for arrival in (False, True):
            checked = read_checked(spark, str(root), entity, with_arrival=arrival)
            assert checked.where("reject is not null").isEmpty()
            plain = read_landing(spark, str(root), entity, with_arrival=arrival)
            assert checked.drop("reject").columns == plain.columns and rows(checked.drop("reject")) == rows(plain)
    assert read_checked(spark, str(root), "boards").isEmpty()
    chosen = read_checked(spark, str(root), "worked_hours", ["south"], "2024-01-01", "2024-01-31")
    assert rows(chosen.select("employeeId", "date")) == [("e3", date(2024, 1, 11))]


def test_one_scan_and_a_limit(spark, bad_employees, tmp_path):
    checked = read_checked(spark, str(bad_employees), "employees")
    accepted, rejected, counts = split_once(checked, f"{tmp_path}/split", most_rejected=0.8)
    assert counts == {"read": 10, "rejected": 7}
    assert accepted.count() == 3 and rejected.count() == 7
    assert "reject" not in accepted.columns
    # Both are read from what was written, not from the landing zone.
    assert all("/split/" in f for f in [*accepted.inputFiles(), *rejected.inputFiles()])
    with pytest.raises(TooManyRejects, match="7 of 10"):
        split_once(checked, f"{tmp_path}/split", most_rejected=0.5)


def test_parse_results_say_why(spark):
    texts = spark.createDataFrame(
        [("3/2/2020", "12,5", "2020-01-01T10:00:00Z"), ("31/02/2020", "n/a", "noon"), ("soon", "", " "), (None, None, None)],
        "day string, cost string, at string",
    )
    rules = {n: (F.col(n), r(F.col(n))) for n, r in {"day": parsed_day_first, "cost": parsed_decimal, "at": parsed_moment}.items()}
    told = [[tuple(e) for e in r[0]] for r in texts.select(errors(rules)).collect()]
    assert told == [
        [],
        [("day", "no such day", "31/02/2020"), ("cost", "not a number", "n/a"), ("at", "not a point in time", "noon")],
        [("day", "no known date format", "soon")],
        [],
    ]
    values = texts.select(parsed_day_first(F.col("day"))["value"], parsed_iso_date(F.col("at"))["reason"]).collect()
    assert [tuple(v) for v in values] == [(date(2020, 2, 3), None), (None, "not a date"), (None, None), (None, None)]


@pytest.fixture
def warehouse(spark, tmp_path):
    root = f"{tmp_path}/warehouse"
    companies = [(1, "ID-Acme", "Acme")]
    spark.createDataFrame(companies, table_schema("dim_company")).write.parquet(f"{root}/dim_company")
    return root


def audit_rows(spark, warehouse):
    return rows(read_table(spark, f"{warehouse}/load_audit").select("name", "read", "rejected", "insert", "update", "unchanged"))


def test_audited_load_of_employees(spark, tmp_path, warehouse):
    root = tmp_path / "landing"
    people = [
        employee("e1", "Acme"),
        employee("e2", "Other"),
        employee("e3", "Acme", dateOfBirth="unknown"),
        employee("e4", "Acme", customFields=[{"slug": "cf_fecha_de_alta", "value": "31/02/2020"}]),
        employee("e5", "Acme", pricePerHour="a lot"),
        employee("e6", "Acme", customFields=[{"slug": "cf_precioh_empresa", "value": ""}]),
    ]
    write_pages(root, "employees", "north", people)
    first = jobs.load_employees_audited(spark, str(root), warehouse, load_id="one")
    # Read twice: as landed records and as flat rows; e2 is refused by the lookup.
    assert {k: first[k] for k in ("insert", "rejected")} == {"insert": 2, "rejected": 4}
    again = jobs.load_employees_audited(spark, str(root), warehouse, load_id="two")
    assert (again["unchanged"], again["insert"]) == (2, 0)
    jobs.load_employees_audited(spark, str(root), warehouse, load_id="two")

    found = read_table(spark, f"{warehouse}/load_rejects")
    told = found.select("entity", "tenant", F.explode("errors").alias("e")).select("entity", "e.field", "e.reason")
    assert rows(told) == [
        ("employees", None, "unknown company"),
        ("employees", "cf_fecha_de_alta", "no such day"),
        ("employees", "date_of_birth", "not a date"),
        ("employees", "pricePerHour", "wrong type"),
    ]
    assert len(audit_rows(spark, warehouse)) == 2
    assert rows(read_table(spark, f"{warehouse}/dim_employee").select("empleado_sesame_id")) == [("e1",), ("e6",)]


def test_a_load_beyond_its_limit_changes_nothing(spark, bad_employees, warehouse):
    with pytest.raises(TooManyRejects):
        jobs.load_employees_audited(spark, str(bad_employees), warehouse, most_rejected=0.1)
    assert read_table(spark, f"{warehouse}/dim_employee", "dim_employee").isEmpty()


def test_any_job_can_be_audited(spark, tmp_path, warehouse):
    root = tmp_path / "landing"
    write_all(root)
    write_raw(root, "departments", "north", '{"data": [', name="bad")

    def load(audit: Audit):
        return jobs.load_departments(spark, str(root), warehouse, read=audit.read)

    counts = audited(spark, warehouse, "dim_department", load)
    assert (counts["read"], counts["rejected"], counts["insert"]) == (3, 1, 2)
    assert audit_rows(spark, warehouse) == [("dim_department", 3, 1, 2, 0, 0)]


def test_stream_quarantines_and_counts(spark, tmp_path, warehouse):
    root, start = tmp_path / "landing", "2024-01-10T08:00:00Z"
    write_pages(root, "time_entries", "north", [time_entry("t1", "e1", start, start)], name="one", at=1_000_000_000)
    write_raw(root, "time_entries", "north", '{"data": [{"id"', name="two")

    def run(most=1.0):
        start_incremental_load(
            stream_checked(spark, str(root), "time_entries", max_files=1),
            lambda batch: facts.time_entries(flatten.flatten_time_entries(batch)),
            f"{warehouse}/fact_time_entry",
            ["time_entry_sesame_id"],
            f"{tmp_path}/checkpoint",
            audit=(warehouse, "time_entries", "fact_time_entry"),
            most_rejected=most,
        ).awaitTermination()

    with pytest.raises(Exception, match="1 of 1 rows rejected"):
        run(most=0.5)
    for _ in range(2):
        run()
    assert audit_rows(spark, warehouse) == [("fact_time_entry", 1, 0, 1, 0, 0), ("fact_time_entry", 1, 1, 0, 0, 0)]
    assert read_table(spark, f"{warehouse}/load_rejects").count() == 1
    assert read_table(spark, f"{warehouse}/fact_time_entry").count() == 1


# ---- generations of an extract


def test_latest_generation(spark):
    data = [("a", 1, None, 5), ("a", 1, "2", 6), ("a", 1, "2", 7), ("a", 2, None, 8), (None, 1, "1", 9), (None, 1, "0", 10)]
    df = spark.createDataFrame(data, "tenant string, day int, extract string, v int")
    assert [r[3] for r in rows(latest_generation(df, ["tenant", "day"], "extract"))] == [9, 6, 7, 8]


def worked(spark, warehouse):
    table = read_table(spark, f"{warehouse}/fact_worked_hours")
    return rows(table.select("employee_sesame_id", "date", "worked_time"))


def test_a_day_that_is_landed_again_is_not_added_up(spark, tmp_path, warehouse):
    root, day = tmp_path / "landing", date(2024, 1, 10)

    def land(extract, tenant, *records, name="part"):
        write_pages(root, "worked_hours", tenant, list(records), date=f"2024-01-10/extract={extract}", name=name)

    def load():
        jobs.load_worked_hours(spark, str(root), warehouse, "2024-01-01", "2024-01-31")
        return worked(spark, warehouse)

    land("20240111T01", "north", hours("e1", 3600), hours("e1", 60), hours("e2", 100))
    land("20240111T01", "south", hours("e3", 7200))
    assert load() == [("e1", day, 3660), ("e2", day, 100), ("e3", day, 7200)]
    land("20240112T01", "north", hours("e1", 4000), name="a")
    land("20240112T01", "north", hours("e2", 100), name="b")
    for _ in range(2):
        assert load() == [("e1", day, 4000), ("e2", day, 100), ("e3", day, 7200)]
    listed = list_landing(spark, str(root), "worked_hours", from_date="2024-01-10", to_date="2024-01-10")
    assert rows(listed.select("employeeId", "secondsWorked")) == [("e1", 4000), ("e2", 100), ("e3", 7200)]
    # An extract without records replaces the day, too.
    land("20240113T01", "south")
    again = read_landing(spark, str(root), "worked_hours", last_only=True)
    assert rows(again.select("employeeId")) == [("e1",), ("e2",)]


def test_pages_may_name_their_extract(spark, tmp_path):
    folder = tmp_path / "worked_hours" / "tenant=north" / "date=2024-01-10"
    folder.mkdir(parents=True)
    pages = [{"data": [hours("e1", 1)]}, {"data": [hours("e1", 2)], "extract": "b"}, {"data": [hours("e2", 3)], "extract": "a"}]
    for i, page in enumerate(pages):
        (folder / f"{i}.json").write_text(json.dumps(page) + "\n")
    for read in (read_landing, read_checked):
        assert rows(read(spark, str(tmp_path), "worked_hours", last_only=True).select("secondsWorked")) == [(2,)]
        assert read(spark, str(tmp_path), "worked_hours").count() == 3


# ---- late rows of a stream


def test_late_rows_reach_the_totals(spark, tmp_path):
    source, table = f"{tmp_path}/in", f"{tmp_path}/table"
    schema = "at timestamp, employeeId string, secondsWorked bigint"

    def add(*data):
        frame = spark.createDataFrame(list(data), "at string, employeeId string, secondsWorked bigint")
        frame.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(source)

    def run():
        clockings = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        args = ("at", "employeeId", "secondsWorked", "1 day")
        start_daily_totals(daily_seconds_stream(clockings, *args), table, f"{tmp_path}/c1").awaitTermination()
        correct_late_days(clockings, *args, table, f"{tmp_path}/c2").awaitTermination()
        got = read_table(spark, table).select("employee_sesame_id", "date", "worked_time")
        everything = spark.read.parquet(source).where("employeeId is not null")
        want = everything.groupBy("employeeId", F.to_date("at").alias("date")).agg(F.sum("secondsWorked"))
        assert rows(got) == rows(want)

    add(("2024-01-01 10:00:00", "e1", 1), ("2024-01-01 11:00:00", "e2", 2))
    add(("2024-01-09 10:00:00", "e1", 4), ("2024-01-09 10:00:00", None, 100))
    add(("2024-01-01 12:00:00", "e1", 8), ("2024-01-02 12:00:00", "e3", 16), ("2024-01-09 11:00:00", "e1", 32))
    run()
    late = late_rows(spark, table).select("employee_sesame_id", "date", "seconds")
    assert rows(late) == [("e1", date(2024, 1, 1), 8), ("e3", date(2024, 1, 2), 16)]
    add(("2024-01-20 10:00:00", "e1", 64))
    add(("2024-01-03 10:00:00", "e9", 128), ("2024-01-01 10:00:00", "e1", 256), ("2024-01-20 11:00:00", "e1", 512))
    for _ in range(2):
        run()
    assert late_rows(spark, table).count() == 4
