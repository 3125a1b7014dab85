import pytest
from conftest import rows
from landing_zone import employee, write_all, write_pages

from jornada.operators import boards
from jornada.plans import jobs
from jornada.plans.listings import list_landing
from jornada.schemas import BOARD_ASSIGNMENT_COLUMN, BOARD_HOURS_COLUMN


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    write_all(folder)
    for tenant in ("north", "south"):
        write_pages(folder, "account", tenant, [{"company": {"id": f"c-{tenant}"}}])
    entry = {
        "employee": {"id": "e1"},
        "workEntryIn": {"date": "2024-01-05T08:00:00+01:00"},
        "workEntryOut": {"date": "2024-01-05T16:00:00+01:00"},
        "updatedAt": "2024-01-06T00:00:00Z",
    }
    entries = [{**entry, "id": "w1"}, {**entry, "id": "w2", "deletedAt": "2024-02-01T00:00:00Z"}, {**entry, "id": "w3"}]
    write_pages(folder, "work_entries", "north", entries, date="2024-01-05")
    extra = employee("e6", "Acme", departmentIds=["d1", "d7"], officeIds=["o1"], code="0042")
    write_pages(folder, "employees", "west", [extra])
    return str(folder)


def ids(df):
    return [r.id for r in df.collect()]


def test_employees(spark, root):
    assert ids(list_landing(spark, root, "employees", department_ids=["d7", "d8"])) == ["e6"]
    assert ids(list_landing(spark, root, "employees", code="0042", office_ids=["o1"])) == ["e6"]
    assert ids(list_landing(spark, root, "employees", email="e3@example.org")) == ["e3"]
    assert ids(list_landing(spark, root, "employees", status="active", order_by="id desc", limit=2, page=2)) == ["e3", "e1"]
    assert sorted(ids(list_landing(spark, root, "employees", tenants=["south"]))) == ["e4", "e5"]


def test_only_the_last_extract_is_listed(spark, tmp_path):
    write_pages(tmp_path, "departments", "north", [{"id": "d1", "name": "Old"}, {"id": "d2", "name": "Two"}], at=1e9)
    write_pages(tmp_path, "departments", "north", [{"id": "d1", "name": "New"}], name="later", at=2e9)
    assert rows(list_landing(spark, str(tmp_path), "departments")) == [("d1", "New"), ("d2", "Two")]
    assert ids(list_landing(spark, str(tmp_path), "departments", name="Old")) == []


def test_work_entries(spark, root):
    asked = {"from_date": "2024-01-05", "to_date": "2024-01-05", "order_by": "id desc"}
    assert ids(list_landing(spark, root, "work_entries", employee_id="e1", **asked)) == ["w3", "w1"]
    assert ids(list_landing(spark, root, "work_entries", only_return="deleted", **asked)) == ["w2"]
    assert ids(list_landing(spark, root, "work_entries", updated_at_gte="2024-01-06 00:00:01", **asked)) == []


def test_time_entries_of_active_employees(spark, root):
    # t3 belongs to an employee nobody knows.
    listed = list_landing(spark, root, "time_entries", from_date="2024-01-01", to_date="2024-12-31")
    assert sorted(ids(listed)) == ["t1", "t2", "t4"]


def test_worked_hours(spark, root):
    asked = {"from_date": "2024-01-10", "to_date": "2024-01-31"}
    listed = list_landing(spark, root, "worked_hours", employee_ids=["e3"], **asked)
    assert [r.secondsWorked for r in listed.collect()] == [7200]
    with pytest.raises(ValueError):
        list_landing(spark, root, "worked_hours", employee_ids=["e3"])


def test_small_entities(spark, root):
    assert ids(list_landing(spark, root, "departments", name="Works")) == ["d2"]
    assert sorted(ids(list_landing(spark, root, "projects", company_id="c-south"))) == ["p1", "p2"]
    assert ids(list_landing(spark, root, "projects", company_id="c-north")) == []
    assert ids(list_landing(spark, root, "department_assignments", employee_id="e1", department_id="d2")) == ["a2"]


def test_board_items(spark, tmp_path):
    def cells(item, hours, label=None):
        values = [
            {"column": {"id": BOARD_HOURS_COLUMN, "title": "Hours"}, "value": hours},
            {"column": {"id": "other", "title": "Other"}, "value": "x"},
        ]
        if label:
            text = f'{{"label":"{label}"}}'
            values.append({"column": {"id": BOARD_ASSIGNMENT_COLUMN, "title": "Who"}, "value": text})
        return {"id": item, "column_values": values}

    write_pages(tmp_path, "boards", "north", [{"id": "b1", "name": "Plan"}, {"id": "b2", "name": "Other"}], at=1e9)
    write_pages(tmp_path, "boards", "south", [{"id": "b3", "name": "Plan"}], at=2e9)
    assert rows(jobs.board_ids(spark, str(tmp_path))) == [("Other", "b2"), ("Plan", "b3")]
    page = {"cursor": "x", "items": [{"id": "i1", "name": "one"}, {"id": "i2", "name": "two"}]}
    write_pages(tmp_path, "board_items", "north", [page], [{"items": [{"id": "i3", "name": "three"}]}])
    write_pages(tmp_path, "item_cells", "north", [cells("i1", "5", "Ann"), cells("i2", None), cells("i9", "7")])
    assert rows(jobs.board_items(spark, str(tmp_path))) == [
        ("i1", "one", "5", "Ann"),
        ("i2", "two", "0", ""),
        ("i3", "three", "0", ""),
    ]


def test_items_and_cells_of_one_board(spark, tmp_path):
    def cells(item, hours):
        return {"id": item, "column_values": [{"column": {"id": BOARD_HOURS_COLUMN, "title": "Hours"}, "value": hours}]}

    pages = [
        {"board_id": "b1", "cursor": "x", "items": [{"id": "i1", "name": "one"}]},
        {"board_id": "b2", "cursor": "y", "items": [{"id": "i2", "name": "two"}]},
        {"board_id": "b1", "items": [{"id": "i3", "name": "three"}]},
        {"items": [{"id": "i4", "name": "four"}]},
    ]
    write_pages(tmp_path, "board_items", "north", pages)
    write_pages(tmp_path, "item_cells", "north", [cells("i1", "5"), cells("i2", "6"), cells("i9", "7")])
    assert rows(jobs.items_of_board(spark, str(tmp_path), "b1")) == [("i1", "one", "5", ""), ("i3", "three", "0", "")]
    assert rows(jobs.items_of_board(spark, str(tmp_path), "b9")) == []
    given = spark.createDataFrame([("i2",), ("i2",), (None,), ("i8",)], "item_id string")
    table = spark.createDataFrame([("i1", "a"), ("i2", "b"), (None, "c")], "item_id string, value string")
    assert rows(boards.cells_of_items(table, given)) == [("i2", "b")]
