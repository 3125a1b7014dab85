from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from jornada.operators.positions import PositionIndex
from jornada.plans import edits as plans
from jornada.plans.edits import load_cell_edits, load_new_employees
from jornada.sources.quarantine import TooManyRejects
from jornada.sources.tables import read_table

EDIT = "edit_id string, board_id string, item_id string, column_id string, value string, edited_at string"


def edits(spark, *data):
    return spark.createDataFrame(list(data), EDIT)


FIRST = [
    ("1", "b", "i", "c", "one", "2024-01-01T10:00:00Z"),
    ("2", "b", "i", "c", "two", "2024-01-02T10:00:00Z"),
    ("3", "b", "j", "c", None, "2024-01-01T10:00:00Z"),
    (None, "b", "i", "c", "no id", "2024-01-09T10:00:00Z"),
    ("4", "b", "i", None, "no column", "2024-01-09T10:00:00Z"),
    ("5", "b", "i", "c", "no moment", "tomorrow"),
    ("6", "b", "i", "c", "none", None),
]
LATE = [("7", "b", "i", "c", "older", "2024-01-01T12:00:00Z"), ("8", "b", "j", "c", "new", "2024-01-03T10:00:00Z")]


def cells(spark, warehouse):
    return rows(read_table(spark, f"{warehouse}/board_cells").select("item_id", "column_id", "value"))


def reject_reasons(spark, warehouse):
    found = read_table(spark, f"{warehouse}/load_rejects").select(F.explode("errors").alias("e"))
    return rows(found.select("e.field", "e.reason"))


def test_edits_in_any_order_and_again(spark, tmp_path):
    ends = []
    for number, loads in enumerate([(FIRST, LATE), (LATE, FIRST), (FIRST, FIRST, LATE, FIRST, LATE)]):
        warehouse = f"{tmp_path}/{number}"
        counts = [load_cell_edits(spark, warehouse, edits(spark, *data)) for data in loads]
        ends.append((cells(spark, warehouse), rows(read_table(spark, f"{warehouse}/cell_edit_log").select("edit_id"))))
        assert reject_reasons(spark, warehouse) == [
            ("column_id", "missing"),
            ("edit_id", "missing"),
            ("edited_at", "missing"),
            ("edited_at", "not a point in time"),
        ]
        assert {(c["read"], c["rejected"]) for c in counts} == {(7, 4), (2, 0)}
    assert ends == [([("i", "c", "two"), ("j", "c", "new")], [("1",), ("2",), ("3",), ("7",), ("8",)])] * 3


def test_a_crash_between_log_and_cells_is_made_good(spark, tmp_path, monkeypatch):
    warehouse = f"{tmp_path}/w"
    merge = plans.merge_into

    def crash(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(plans, "merge_into", crash)
    with pytest.raises(RuntimeError):
        load_cell_edits(spark, warehouse, edits(spark, *FIRST))
    monkeypatch.setattr(plans, "merge_into", merge)
    assert load_cell_edits(spark, warehouse, edits(spark, *FIRST))["insert"] == 2
    assert cells(spark, warehouse) == [("i", "c", "two"), ("j", "c", None)]
    assert read_table(spark, f"{warehouse}/cell_edit_log").count() == 3
    assert [r[0] for r in rows(read_table(spark, f"{warehouse}/board_cells").select("edited_at"))] == [
        datetime(2024, 1, 1, 10),
        datetime(2024, 1, 2, 10),
    ]


def test_too_many_bad_edits_change_nothing(spark, tmp_path):
    warehouse = f"{tmp_path}/w"
    with pytest.raises(TooManyRejects):
        load_cell_edits(spark, warehouse, edits(spark, *FIRST), most_rejected=0.5)
    assert read_table(spark, f"{warehouse}/board_cells", "dim_company").isEmpty()


def test_new_employees(spark, tmp_path):
    warehouse = f"{tmp_path}/w"
    columns = "companyId string, firstName string, lastName string, email string, nid string, phone string"

    def load(*data):
        return load_new_employees(spark, warehouse, spark.createDataFrame(list(data), columns))

    ann, bob = ("c1", "Ann", "A", "a@x.org", "n1", None), ("c1", "Bob", "B", "b@x.org", "n2", "1")
    first = load(ann, ann, bob, ("c1", "Bo", "B", "b@x.org", "n2", "1"), ("c2", "", "C", "c@x.org", "n3", None))
    assert (first["read"], first["rejected"], first["insert"]) == (4, 2, 2)
    table = read_table(spark, f"{warehouse}/employee_requests")
    stored = {r.nid: r for r in table.collect()}
    assert stored["n1"].body == '{"companyId":"c1","firstName":"Ann","lastName":"A","email":"a@x.org","nid":"n1"}'
    assert stored["n1"].employee_id is not None and stored["n1"].employee_id != stored["n2"].employee_id
    again = load(ann, ("c1", "Bob", "Changed", "b@x.org", "n2", "1"), ("c3", "Di", "D", "d@x.org", "n1", None))
    assert (again["insert"], again["unchanged"], again["update"], again["rejected"]) == (1, 1, 0, 1)
    assert reject_reasons(spark, warehouse) == [
        (None, "known employee"),
        (None, "repeated employee"),
        ("firstName", "missing"),
    ]
    kept = {r.nid: r.lastName for r in read_table(spark, f"{warehouse}/employee_requests").where("companyId = 'c1'").collect()}
    assert kept == {"n1": "A", "n2": stored["n2"].lastName}


# ---- an index of positions


@pytest.fixture(scope="module")
def wide(spark):
    """Ties, nulls, equal rows, and one value of a third of all rows."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        (F.col("id") % 7).alias("v"),
        F.array(F.col("id") % 2).alias("list"),
    )
    return df.repartition(5).cache()


@pytest.mark.parametrize("order", ["k asc, v desc", "v desc", "k"])
def test_pages_make_up_the_listing(spark, wide, order):
    with PositionIndex(wide, order) as index:
        assert index.rows == 3000
        pages = [index.page(700, n).collect() for n in range(1, 7)]
    assert [len(p) for p in pages] == [700] * 4 + [200, 0]
    found = [tuple(r) for p in pages for r in p]
    assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in wide.collect())
    parts = [part.split() for part in order.split(",")]
    wanted = wide.orderBy(*[F.col(p[0]).desc_nulls_last() if p[-1] == "desc" else F.col(p[0]).asc_nulls_last() for p in parts])
    names = [p[0] for p in parts]
    assert [tuple(r[wide.columns.index(n)] for n in names) for r in found] == [tuple(r) for r in wanted.select(*names).collect()]


def test_an_index_holds_keys_alone_and_is_removed(spark, wide, tmp_path):
    from jornada.sources.files import exists

    with PositionIndex(wide, "v", ["k"]) as index:
        assert spark.read.parquet(index.folder).columns == ["v", "k", "_row", "_at"]
        plan = index._index.where("_at >= 5 and _at < 9")._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(_at), GreaterThanOrEqual(_at,5), LessThan(_at,9)]" in plan
        page = index.page(10, 250)
    assert not exists(spark, index.folder)
    assert page.count() == 10
    with pytest.raises(ValueError):
        index.page(0)
