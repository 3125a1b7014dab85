import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jornada.operators import boards, quality
from jornada.schemas import BOARD_ASSIGNMENT_COLUMN, BOARD_HOURS_COLUMN, landing_schema


def test_last_board_of_a_name_wins(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 1)], "name string, id string, arrival int")
    assert rows(boards.board_ids(df)) == [("a", "2"), ("b", "3")]


def test_items_of_all_pages(spark):
    data = [(1, [("i1", "old"), ("i2", "two")]), (2, [("i1", "new")]), (3, [])]
    pages = spark.createDataFrame(data, "arrival int, items array<struct<id:string,name:string>>")
    assert rows(boards.board_items(pages)) == [("i1", "new"), ("i2", "two")]


def test_pivot_keeps_hours_before_other_columns(spark):
    def cell(column, value):
        return ((column, column), value)

    assigned = '{"personsAndTeams":[{"id":9}],"name":"Ann"}'
    data = [
        ("i1", [cell(BOARD_HOURS_COLUMN, "12"), cell("other", "x"), cell(BOARD_ASSIGNMENT_COLUMN, '{"label":"Ann"}')]),
        ("i2", [cell("other", "x"), cell(BOARD_HOURS_COLUMN, None), cell(BOARD_ASSIGNMENT_COLUMN, "")]),
        ("i3", []),
        ("i4", [cell(BOARD_ASSIGNMENT_COLUMN, assigned)]),
    ]
    raw = spark.createDataFrame(data, landing_schema("item_cells"))
    items = spark.createDataFrame([(f"i{n}", f"name{n}") for n in range(1, 6)], "item_id string, name string")
    table = boards.items_with_cells(items, boards.cells(raw))
    assert rows(table) == [
        ("i1", "name1", "12", "Ann"),
        ("i2", "name2", "0", ""),
        ("i3", "name3", "0", ""),
        ("i4", "name4", "0", "id"),
        ("i5", "name5", "0", ""),
    ]
    by_field = F.get_json_object("value", "$.name")
    exact = boards.pivot_cells(boards.cells(raw).where("item_id = 'i4'"), assignee=by_field)
    assert rows(exact) == [("i4", "0", "Ann")]


def test_last_cell_edit_wins(spark):
    key = "board_id string, item_id string, column_id string, value string"
    table = spark.createDataFrame([("b", "i", "c", "old"), ("b", "i", "d", "stays")], key)
    edits = spark.createDataFrame(
        [("b", "i", "c", "first", 1), ("b", "i", "c", "last", 2), ("b", "j", "c", "new", 1)], key + ", edited_at int"
    )
    edited = boards.apply_cell_edits(table, edits)
    assert rows(edited) == [("b", "i", "c", "last"), ("b", "i", "d", "stays"), ("b", "j", "c", "new")]


def test_required_fields(spark):
    columns = "companyId string, firstName string, lastName string, email string, nid string"
    df = spark.createDataFrame([("c", "", "l", "e", None), ("c", "f", "l", "e", "n")], columns)
    valid, rejected = quality.validate_required(df)
    assert rows(valid) == [("c", "f", "l", "e", "n")]
    assert [r.missing_fields for r in rejected.collect()] == ["firstName,nid"]


def test_request_body_has_no_null_fields(spark):
    df = spark.createDataFrame([("a", None, 0)], "x string, y string, z int")
    assert df.select(quality.request_body(df)).first()[0] == '{"x":"a","z":0}'


def test_null_rules(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "t", None), (3, "t", "x")], "id int, tarea string, etiqueta string")
    assert [r.id for r in quality.drop_nulls(df).collect()] == [3]
    assert rows(quality.drop_nulls(df, ["tarea"]).select("id")) == [(2,), (3,)]
    filled = quality.fill_nulls(df, {"tarea": "", "etiqueta": "No especificada"})
    assert rows(filled) == [(1, "", "x"), (2, "t", "No especificada"), (3, "t", "x")]


def test_assert_complete_fails_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert quality.assert_complete(df, ["id"]).count() == 2
    with pytest.raises(PySparkException, match="lacks one of: id, v"):
        quality.assert_complete(df, ["id", "v"]).collect()
