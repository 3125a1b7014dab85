import functools
import re
from datetime import date, datetime

import pytest
from conftest import rows
from landing_zone import assignment, employee, hours, time_entry, write_all, write_pages
from pyspark.sql import functions as F

from jornada.operators import flatten
from jornada.plans import facts, jobs
from jornada.schemas import table_schema
from jornada.sources.csv_text import from_csv_lines, read_csv, to_csv_lines, write_csv
from jornada.sources.landing import read_bad_pages, read_landing, with_company_id
from jornada.sources.tables import read_table


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    write_all(root)
    return str(root)


@pytest.fixture
def warehouse(spark, tmp_path):
    root = f"{tmp_path}/warehouse"
    spark.createDataFrame([(1, "ID-Acme", "Acme "), (2, "ID-Bolt", "Bolt")], table_schema("dim_company")).write.parquet(
        f"{root}/dim_company"
    )
    spark.createDataFrame([(7, "Area d2")], table_schema("dim_departamento")).write.parquet(f"{root}/dim_departamento")
    return root


def test_all_tenants_and_pages_in_one_read(spark, landing):
    people = read_landing(spark, landing, "employees")
    assert rows(people.select("tenant", "id")) == [("north", f"e{i}") for i in (1, 2, 3)] + [
        ("south", f"e{i}") for i in (4, 5)
    ]
    assert read_landing(spark, landing, "employees", tenants=["south"]).count() == 2


def test_codes_stay_text(spark, landing):
    assert {r.postalCode for r in read_landing(spark, landing, "employees").collect()} == {"01234"}


def test_date_range_reads_only_its_folders(spark, landing):
    chosen = read_landing(spark, landing, "worked_hours", from_date="2024-01-10", to_date="2024-01-31")
    assert {r.date for r in chosen.collect()} == {date(2024, 1, 10), date(2024, 1, 11)}
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-10", plan)


def test_nothing_landed_gives_an_empty_table(spark, landing, tmp_path):
    chosen = read_landing(spark, landing, "worked_hours", from_date="2025-01-01", to_date="2025-01-02")
    assert chosen.isEmpty() and "secondsWorked" in chosen.columns
    nothing = read_landing(spark, str(tmp_path), "worked_hours")
    assert nothing.isEmpty() and nothing.columns == chosen.columns
    assert facts.worked_hours(nothing).isEmpty()


def test_bad_pages(spark, tmp_path):
    write_pages(tmp_path, "departments", "north", [{"id": "d1", "name": "Sales"}])
    (tmp_path / "departments" / "tenant=north" / "bad.json").write_text('{"data": [{"id": \n')
    assert read_landing(spark, str(tmp_path), "departments").count() == 1
    assert rows(read_bad_pages(spark, str(tmp_path), "departments")) == [("north", '{"data": [{"id": ')]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_landing(spark, str(tmp_path), "departments", mode="FAILFAST").collect()


def test_a_job_fails_on_one_bad_page_where_asked(spark, tmp_path):
    """The strict reader fails the whole load, which leaves the table as the load before made it."""
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    strict = functools.partial(read_landing, mode="FAILFAST")
    write_pages(landing, "departments", "north", [{"id": "d1", "name": "Sales"}])
    jobs.load_departments(spark, str(landing), store, read=strict)
    before = rows(read_table(spark, f"{store}/dim_department"))
    write_pages(landing, "departments", "south", [{"id": "d2", "name": "Works"}])
    (landing / "departments" / "tenant=south" / "bad.json").write_text('{"data": [{"id": \n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.load_departments(spark, str(landing), store, read=strict)
    assert rows(read_table(spark, f"{store}/dim_department")) == before and len(before) == 1
    jobs.load_departments(spark, str(landing), store)
    assert read_table(spark, f"{store}/dim_department").count() == 2


def test_work_entries_quarantine(spark, tmp_path):
    good = {
        "id": "w1",
        "employee": {"id": "e1"},
        "workEntryIn": {"date": "2024-01-01"},
        "workEntryOut": {"date": "2024-01-02"},
    }
    write_pages(tmp_path, "work_entries", "north", [good, {**good, "id": "w2", "workEntryOut": None}])
    flat, rejected = flatten.flatten_work_entries(read_landing(spark, str(tmp_path), "work_entries"))
    assert [r.id for r in flat.collect()] == ["w1"]
    assert [r.id for r in rejected.collect()] == ["w2"]


def test_company_of_each_tenant(spark, tmp_path):
    for tenant in ("north", "south"):
        write_pages(tmp_path, "account", tenant, [{"company": {"id": f"c-{tenant}"}}])
        write_pages(tmp_path, "projects", tenant, [{"id": f"p-{tenant}", "projectStatus": {"value": "open"}}])
    projects = read_landing(spark, str(tmp_path), "projects")
    joined = with_company_id(projects, read_landing(spark, str(tmp_path), "account"))
    assert rows(joined.select("id", "company_id")) == [("p-north", "c-north"), ("p-south", "c-south")]


def test_employee_dimension(spark, landing, warehouse):
    counts, rejected = jobs.load_employees(spark, landing, warehouse)
    assert counts["insert"] == 3
    assert [r.empleado_sesame_id for r in rejected.collect()] == ["e4"]
    dim = read_table(spark, f"{warehouse}/dim_employee")
    assert set(dim.columns) == set(table_schema("dim_employee").names)
    people = {r.empleado_sesame_id: r for r in dim.collect()}
    assert sorted(people) == ["e1", "e2", "e3"]
    e1, e2 = people["e1"], people["e2"]
    assert (e1.empresa_id, people["e3"].empresa_id) == (1, 2)
    assert (e1.area, e1.costo_hora_empresa, e1.codigo_postal, e1.num_hijos) == ("Field work", 12.5, "01234", 0)
    assert (e1.fecha_alta, e1.fecha_baja) == (date(2020, 2, 3), date(2023, 11, 30))
    assert (e2.area, e2.nid, e2.sexo, e2.costo_hora_empresa, e2.fecha_baja) == ("", "", "", None, None)
    assert people["e3"].num_hijos == 2


def run_all(spark, landing, warehouse, mart, first="2024-01-01", last="2024-12-31"):
    jobs.load_departments(spark, landing, warehouse)
    jobs.load_department_assignments(spark, landing, warehouse)
    jobs.load_projects(spark, landing, warehouse)
    jobs.load_employees(spark, landing, warehouse)
    jobs.load_time_entries(spark, landing, warehouse, first, last)
    jobs.load_worked_hours(spark, landing, warehouse, first, last)
    jobs.load_time_charges_and_signings(spark, landing, warehouse, first, last, company_aliases=[("nobody", 3)])
    jobs.build_mart_time_entries(spark, warehouse, mart, first, last)
    jobs.build_mart_worked_hours(spark, warehouse, mart, first, last)


TABLES = [
    "warehouse/dim_department",
    "warehouse/dim_project",
    "warehouse/fact_department_assignment",
    "warehouse/dim_employee",
    "warehouse/fact_time_entry",
    "warehouse/fact_worked_hours",
    "warehouse/fact_time_charge",
    "warehouse/fact_signing",
    "mart/mart_time_entry",
    "mart/mart_worked_hours",
]


def test_all_jobs_and_that_they_can_be_repeated(spark, landing, warehouse, tmp_path):
    mart = f"{tmp_path}/mart"

    def state():
        return {t: rows(read_table(spark, f"{tmp_path}/{t}")) for t in TABLES}

    run_all(spark, landing, warehouse, mart)
    first = state()

    entries = {r.imputacion_id: r for r in read_table(spark, f"{mart}/mart_time_entry").collect()}
    assert sorted(entries) == ["t1", "t2", "t3", "t4"]
    t1, t2, t3 = entries["t1"], entries["t2"], entries["t3"]
    assert (t1.empleado_id, t1.nombres, t1.nombre_departamento) == ("e1", "First e1", "Works")
    assert (t1.fecha, t1.year, t1.mes, t1.hora_inicio, t1.hora_fin) == (date(2024, 1, 10), 2024, 1, "07:00", "08:30")
    assert (t1.nombre_cliente, t1.nombre_proyecto, t1.etiquetas, t1.horas_imputadas) == ("Town", "Bridge", "a,b", 1.5)
    assert (t2.fecha, t2.horas_imputadas, t2.id_proyecto, t2.nombre_proyecto) == (date(2024, 1, 10), 0.75, "", None)
    assert (t3.empleado_id, t3.nombres, t3.nombre_cliente) == (None, None, "")

    stored = {r.time_entry_sesame_id: r for r in read_table(spark, f"{warehouse}/fact_time_entry").collect()}
    assert len(stored["t1"].comment) == 200
    assert stored["t1"].time_entry_in == datetime(2024, 1, 10, 7)

    daily = read_table(spark, f"{mart}/mart_worked_hours")
    assert rows(daily.select("empleado_id", "fecha", "tiempo_trabajado", "tiempo_teorico")) == [
        ("e1", date(2024, 1, 10), 1.0, 16.0),
        ("e3", date(2024, 1, 11), 2.0, 8.0),
        ("e3", date(2024, 3, 1), 100 / 3600, 8.0),
    ]

    # e2 has no national id, t3's employee is unknown, t2 has no project: none is charged.
    charges = read_table(spark, f"{warehouse}/fact_time_charge")
    assert rows(charges.select("proyecto", "etiqueta", "empresa_id", "departamento_id", F.length("tarea"))) == [
        ("p1", "a,b", 1, 7, 300),
        ("p9", "No especificada", 2, 35, 0),
    ]
    signed = read_table(spark, f"{warehouse}/fact_signing")
    assert rows(signed.select("fecha", "tiempo_trabajado", "departamento_id")) == [
        (date(2024, 1, 10), 3600.0, 7),
        (date(2024, 1, 11), 7200.0, 35),
        (date(2024, 3, 1), 100.0, 35),
    ]

    run_all(spark, landing, warehouse, mart)
    assert state() == first


def test_changed_extracts_update_the_mart(spark, landing, warehouse, tmp_path):
    mart = f"{tmp_path}/mart"
    run_all(spark, landing, warehouse, mart)
    root = tmp_path / "landing"
    # t4 moves from February to March; e1 changes department and price.
    moved = time_entry("t4", "e3", "2024-03-01T08:00:00Z", "2024-03-01T08:30:00Z", "p1")
    write_pages(root, "time_entries", "south", [moved], date="2024-02-01")
    write_pages(
        root, "department_assignments", "north", [assignment("a4", "e1", "d1", "2024-05-01T10:00:00Z")], name="later"
    )
    write_pages(root, "employees", "north", [employee("e1", "Acme", firstName="New"), employee("e3", "Bolt")])
    write_pages(root, "worked_hours", "south", [hours("e3", 3600)], date="2024-01-11")
    run_all(spark, landing, warehouse, mart)
    entries = {r.imputacion_id: r for r in read_table(spark, f"{mart}/mart_time_entry").collect()}
    assert len(entries) == 4
    assert (entries["t4"].mes, entries["t4"].horas_imputadas, entries["t4"].nombre_proyecto) == (3, 0.5, "Bridge")
    assert (entries["t1"].nombres, entries["t1"].nombre_departamento) == ("New", "Sales")
    people = read_table(spark, f"{warehouse}/dim_employee")
    assert people.count() == 3
    daily = read_table(spark, f"{mart}/mart_worked_hours").where("fecha = date'2024-01-11'")
    assert [r.tiempo_trabajado for r in daily.collect()] == [1.0]


def test_last_extract_of_a_record_wins(spark, tmp_path, warehouse):
    root = tmp_path / "landing"
    one, two = employee("e1", "Acme"), employee("e2", "Acme")
    write_pages(root, "employees", "north", [one, two], name="a", at=2_000_000_000)
    write_pages(root, "employees", "north", [{**one, "firstName": "Old"}], name="b", at=1_000_000_000)
    write_pages(root, "employees", "north", [{**two, "status": "candidate"}], name="c", at=2_100_000_000)
    counts, _ = jobs.load_employees(spark, str(root), warehouse)
    assert counts["insert"] == 1
    assert [r.nombre for r in read_table(spark, f"{warehouse}/dim_employee").collect()] == ["First e1"]

    start, end = "2024-01-10T08:00:00Z", "2024-01-10T09:00:00Z"
    later = [time_entry("t1", "e1", "2024-01-12T08:00:00Z", "2024-01-12T10:00:00Z")]
    write_pages(root, "time_entries", "north", [time_entry("t1", "e1", start, end)], date="2024-01-10", at=1_000_000_000)
    write_pages(root, "time_entries", "north", later, date="2024-01-12", at=1_000_000_500)
    jobs.load_time_entries(spark, str(root), warehouse, "2024-01-10", "2024-01-12")
    stored = read_table(spark, f"{warehouse}/fact_time_entry").collect()
    assert [r.time_entry_in for r in stored] == [datetime(2024, 1, 12, 8)]


def test_loading_an_old_range_again_keeps_newer_versions(spark, tmp_path, warehouse):
    root = tmp_path / "landing"
    start, end = "2024-01-05T08:00:00Z", "2024-01-05T09:00:00Z"
    old, new = (time_entry("x1", "e1", start, end, comment=c) for c in ("old", "new"))
    moved = time_entry("x2", "e1", "2024-02-10T08:00:00Z", "2024-02-10T09:00:00Z")
    write_pages(root, "time_entries", "north", [old, time_entry("x2", "e1", start, end)], date="2024-01-05", at=1_000_000_000)
    january, february = ("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29")
    jobs.load_time_entries(spark, str(root), warehouse, *january)
    write_pages(root, "time_entries", "north", [new, moved], date="2024-02-10", at=1_000_000_500)
    jobs.load_time_entries(spark, str(root), warehouse, *february)
    table = f"{warehouse}/fact_time_entry"
    before = {r.time_entry_sesame_id: (r.comment, r.time_entry_in) for r in read_table(spark, table).collect()}
    jobs.load_time_entries(spark, str(root), warehouse, *january)
    after = {r.time_entry_sesame_id: (r.comment, r.time_entry_in) for r in read_table(spark, table).collect()}
    assert before["x2"][1] == after["x2"][1] == datetime(2024, 2, 10, 8)
    # The edit of x1 landed in February, but its day is in January.
    assert after["x1"] == ("new", datetime(2024, 1, 5, 8))


def test_csv_files_and_lines(spark, tmp_path):
    schema = table_schema("dim_department")
    df = spark.createDataFrame([("01", 'Sales, "north"'), ("02", None), (" 03 ", ""), ("04", "a\nb")], schema)
    write_csv(df, f"{tmp_path}/out")
    expected = rows(df.replace("", None))
    assert rows(read_csv(spark, f"{tmp_path}/out", schema, multi_line=True)) == expected
    assert rows(from_csv_lines(to_csv_lines(df), schema)) == expected
    write_csv(df.where("department_sesame_id <> '04'"), f"{tmp_path}/plain")
    assert read_csv(spark, f"{tmp_path}/plain", schema).count() == 3
