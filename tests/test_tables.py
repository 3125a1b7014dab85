from datetime import date, datetime

import pytest
from conftest import rows

from jornada.sources import tables
from jornada.sources.files import exists
from jornada.sources.tables import append_new_rows, delete_from, load_report, merge_into, read_days, read_table

FACT = "k int, month int, v string"


def fact(spark, *data):
    return spark.createDataFrame(list(data), FACT)


def content(spark, path):
    return rows(read_table(spark, path).select("k", "month", "v"))


def in_month(spark, path, month):
    """Files that the table's partition is read from."""
    return sorted(f for f in read_table(spark, path).inputFiles() if f"/month={month}/" in f)


def test_missing_table_is_empty_with_its_schema(spark, tmp_path):
    df = read_table(spark, f"{tmp_path}/nothing", "mart_worked_hours")
    assert df.isEmpty() and df.columns[0] == "fichaje_diario_id"


def test_create_then_merge(spark, tmp_path):
    path = f"{tmp_path}/t"
    counts = merge_into(spark, path, fact(spark, (1, 1, "a"), (2, 1, "b")), ["k"])
    assert counts == {"insert": 2, "update": 0, "unchanged": 0, "keep": 0}
    counts = merge_into(spark, path, fact(spark, (2, 1, "B"), (3, 2, "c")), ["k"])
    assert counts == {"insert": 1, "update": 1, "unchanged": 0, "keep": 1}
    expected = [(1, 1, "a"), (2, 1, "B"), (3, 2, "c")]
    assert content(spark, path) == expected
    files = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
    counts = merge_into(spark, path, fact(spark, (2, 1, "B"), (3, 2, "c")), ["k"])
    assert counts == {"insert": 0, "update": 0, "unchanged": 2, "keep": 1}
    assert sorted(p.name for p in (tmp_path / "t").rglob("*.parquet")) == files
    assert content(spark, path) == expected
    assert not exists(spark, f"{path}.staged") and not exists(spark, f"{path}.incoming")
    assert rows(load_report(spark, path, fact(spark, (2, 1, "x"), (9, 1, "y")), ["k"])) == [
        ("insert", 1),
        ("keep", 2),
        ("update", 1),
    ]


def test_partitioned_merge_moves_rows_and_drops_emptied_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a"), (2, 2, "b"), (3, 2, "c"), (4, 3, "d")), ["k"], ["month"])
    untouched = in_month(spark, path, 3)
    merge_into(spark, path, fact(spark, (1, 2, "a2"), (5, 4, "e")), ["k"], ["month"])
    assert content(spark, path) == [(1, 2, "a2"), (2, 2, "b"), (3, 2, "c"), (4, 3, "d"), (5, 4, "e")]
    assert in_month(spark, path, 1) == []
    assert in_month(spark, path, 3) == untouched != []


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    fact(spark, *[(i, i, "v") for i in range(1, 6)]).write.partitionBy("month").parquet(path)
    chosen = spark.read.parquet(path).where(tables._folder(["month"]).isin(["month=2", "month=4"]))
    assert [r[1] for r in rows(chosen.select("k", "month"))] == [2, 4]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws(/" in plan and "DataFilters: []" in plan


def test_partitioned_merge_with_null_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, None, "a"), (2, 2, "b")), ["k"], ["month"])
    merge_into(spark, path, fact(spark, (1, 2, "a2"), (3, None, "c")), ["k"], ["month"])
    assert content(spark, path) == [(1, 2, "a2"), (2, 2, "b"), (3, None, "c")]
    merge_into(spark, path, fact(spark, (3, 2, "c2")), ["k"], ["month"])
    assert content(spark, path) == [(1, 2, "a2"), (2, 2, "b"), (3, 2, "c2")]


def test_key_that_fixes_the_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a"), (1, 2, "b")), ["k", "month"], ["month"])
    merge_into(spark, path, fact(spark, (1, 2, "B"), (2, 2, "c")), ["k", "month"], ["month"])
    merge_into(spark, path, fact(spark, (2, 2, "C")), ["k"], ["month"], rows_move=False)
    assert content(spark, path) == [(1, 1, "a"), (1, 2, "B"), (2, 2, "C")]


def test_empty_merge_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a")), ["k"], ["month"])
    merge_into(spark, path, fact(spark), ["k"], ["month"])
    assert content(spark, path) == [(1, 1, "a")]


@pytest.mark.parametrize("parts", [[], ["month"]])
@pytest.mark.parametrize("crash_at", ["before the list", "within the list"])
def test_a_crash_loses_nothing(spark, tmp_path, monkeypatch, parts, crash_at):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a"), (2, 2, "b")), ["k"], parts)
    switch, new = tables._switch, fact(spark, (2, 2, "B"), (3, 2, "c"))

    def crash(session, table, number, *rest):
        if crash_at == "within the list":
            switch(session, table, number, *rest)
            (tmp_path / "t" / "_pointers" / str(number) / "_SUCCESS").unlink()
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_switch", crash)
    with pytest.raises(RuntimeError):
        merge_into(spark, path, new, ["k"], parts)
    monkeypatch.setattr(tables, "_switch", switch)
    # The table is as it was, reading it writes nothing, and the load is simply run again.
    files = sorted(tmp_path.rglob("*"))
    assert content(spark, path) == [(1, 1, "a"), (2, 2, "b")]
    assert sorted(tmp_path.rglob("*")) == files
    merge_into(spark, path, new, ["k"], parts)
    assert content(spark, path) == [(1, 1, "a"), (2, 2, "B"), (3, 2, "c")]


@pytest.mark.parametrize("parts", [[], ["month"]])
def test_a_running_reader_keeps_its_version(spark, tmp_path, parts):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a"), (2, 2, "b")), ["k"], parts)
    reader = read_table(spark, path)
    merge_into(spark, path, fact(spark, (2, 2, "B")), ["k"], parts)
    assert rows(reader.select("k", "v")) == [(1, "a"), (2, "b")]
    # Versions before the last two are removed.
    for i in range(3):
        merge_into(spark, path, fact(spark, (2, 2, f"B{i}")), ["k"], parts)
    assert content(spark, path) == [(1, 1, "a"), (2, 2, "B2")]
    assert sorted(p.name for p in (tmp_path / "t" / "_pointers").iterdir()) == ["3", "4"]
    assert len(list((tmp_path / "t").rglob("month=2/*.parquet" if parts else "_load=*/*.parquet"))) == 2


@pytest.mark.parametrize("parts", [[], ["month"]])
def test_merge_into_a_folder_that_spark_wrote(spark, tmp_path, parts):
    path = f"{tmp_path}/t"
    fact(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c")).write.partitionBy(*parts).parquet(path)
    merge_into(spark, path, fact(spark, (2, 3, "B"), (4, 3, "d")), ["k"], parts)
    assert content(spark, path) == [(1, 1, "a"), (2, 3, "B"), (3, 3, "c"), (4, 3, "d")]
    append_new_rows(spark, path, fact(spark, (4, 1, "x"), (5, 1, "e"), (5, 1, "e")), ["k"], partition_by=parts)
    assert content(spark, path)[3:] == [(4, 3, "d"), (5, 1, "e"), (5, 1, "e")]


VERSIONED = "k int, at timestamp, tie int, month int, v string"


def test_loads_in_wrong_order_give_the_same_table(spark, tmp_path):
    def frame(*data):
        parsed = [(k, datetime.fromisoformat(at) if at else None, *rest) for k, at, *rest in data]
        return spark.createDataFrame(parsed, VERSIONED)

    loads = [
        frame((1, "2024-01-01", 1, 1, "a"), (2, None, 0, 1, "b"), (3, "2024-01-05", 2, 2, "c")),
        frame((1, "2024-01-02", 1, 2, "a2"), (2, "2024-01-01", 0, 1, "b2"), (3, "2024-01-05", 1, 3, "older")),
        frame((1, "2024-01-01", 9, 3, "a1"), (4, "2024-01-01", 1, 1, "d")),
    ]
    found = []
    for number, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2), (1, 2, 0, 1, 2, 0)]):
        path = f"{tmp_path}/t{number}"
        counts = [merge_into(spark, path, loads[i], ["k"], ["month"], version=("at", "tie")) for i in order]
        found.append(rows(read_table(spark, path).select("k", "month", "v")))
    assert found == [[(1, 2, "a2"), (2, 1, "b2"), (3, 2, "c"), (4, 1, "d")]] * 4
    assert counts[-1]["stale"] == 2 and counts[-1]["update"] == 0


def test_version_needs_its_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a")), ["k"])
    with pytest.raises(ValueError, match="no column for the version"):
        merge_into(spark, path, fact(spark, (1, 1, "b")), ["k"], version=("at",))
    assert content(spark, path) == [(1, 1, "a")]


def test_repeated_source_key_is_refused_and_table_kept(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a")), ["k"])
    with pytest.raises(ValueError):
        merge_into(spark, path, fact(spark, (2, 1, "a"), (2, 1, "b")), ["k"])
    assert content(spark, path) == [(1, 1, "a")]


def test_repeated_table_key_is_refused_and_table_kept(spark, tmp_path):
    path = f"{tmp_path}/t"
    fact(spark, (1, 1, "a"), (1, 2, "b")).write.parquet(path)
    with pytest.raises(ValueError, match="not unique in the table"):
        merge_into(spark, path, fact(spark, (1, 1, "c")), ["k"])
    assert content(spark, path) == [(1, 1, "a"), (1, 2, "b")]


def test_empty_first_load_leaves_no_table(spark, tmp_path):
    for parts in ([], ["month"]):
        path = f"{tmp_path}/t{len(parts)}"
        assert merge_into(spark, path, fact(spark), ["k"], parts)["insert"] == 0
        append_new_rows(spark, path, fact(spark), ["k"], partition_by=parts)
        assert not tables.has_table(spark, path)
        merge_into(spark, path, fact(spark, (1, 1, "a")), ["k"], parts)
        assert content(spark, path) == [(1, 1, "a")]


@pytest.mark.parametrize("parts", [[], ["month"]])
def test_delete_from(spark, tmp_path, parts):
    path = f"{tmp_path}/t"
    merge_into(spark, path, fact(spark, (1, 1, "a"), (2, 2, "b"), (3, 2, "c"), (4, 3, "d")), ["k"], parts)
    gone = spark.createDataFrame([(1,), (3,), (3,), (9,)], "k int")
    for _ in range(2):
        delete_from(spark, path, gone, ["k"], parts)
        assert content(spark, path) == [(2, 2, "b"), (4, 3, "d")]


def test_append_new_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    d = [date(2024, 1, i) for i in range(1, 10)]
    schema = "k int, day date, v string"
    append_new_rows(spark, path, spark.createDataFrame([(1, d[0], "a"), (2, d[1], "b")], schema), ["k", "day"])
    new = spark.createDataFrame([(1, d[0], "x"), (2, d[2], "c"), (2, d[2], "c2")], schema)
    for _ in range(2):
        append_new_rows(spark, path, new, ["k", "day"], "day", (d[0], d[2]))
        assert [r[2] for r in rows(read_table(spark, path))] == ["a", "b", "c", "c2"]
    assert read_days(spark, path, "day", d[1], d[2]).count() == 3


def test_surrogate_survives_updates(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(spark, path, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], surrogate="sid")
    first = read_table(spark, path).first().sid
    merge_into(spark, path, spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"], surrogate="sid")
    merged = {r.k: r for r in read_table(spark, path).collect()}
    assert merged[1].sid == first and merged[1].v == "b" and merged[2].sid is not None
