import random

import pytest
from conftest import rows

from jornada.operators.lookup import lookup_contains

PATHS = pytest.mark.parametrize("inline_rows", [64, 0], ids=["inline", "substrings"])


def look(spark, dim, fields, **how):
    dim = spark.createDataFrame(dim, "id int, name string")
    df = spark.createDataFrame(list(enumerate(fields)), "n int, field string")
    found = lookup_contains(df, "field", dim, "name", "id", "id", "found", **how)
    assert found.columns == ["n", "field", "found"]
    return [r[0] for r in found.orderBy("n").select("found").collect()]


@PATHS
def test_first_row_in_order_wins(spark, inline_rows):
    dim = [(2, "Acme North"), (1, "Acme \t"), (3, "Norte"), (4, None)]
    fields = ["ACME NORTH SL", "norte", None, "zzz", "norte  "]
    assert look(spark, dim, fields, inline_rows=inline_rows) == [1, 3, None, None, 3]


@PATHS
def test_default_and_aliases(spark, inline_rows):
    dim = [(1, "Acme")]
    fields = ["acme old place", "the OLD place", None, "zzz"]
    how = {"default": 35, "aliases": [("Old Place ", 7)], "inline_rows": inline_rows}
    assert look(spark, dim, fields, **how) == [1, 7, 35, 35]


@PATHS
def test_empty_text_is_contained_in_everything(spark, inline_rows):
    assert look(spark, [(9, ""), (10, "Acme")], ["anything", "", None], inline_rows=inline_rows) == [9, 9, None]


@PATHS
def test_left_whitespace_counts(spark, inline_rows):
    assert look(spark, [(1, " acme")], ["acme", "the acme"], inline_rows=inline_rows) == [None, 1]


@PATHS
def test_empty_dimension(spark, inline_rows):
    assert look(spark, [], ["a"], default=5, inline_rows=inline_rows) == [5]


@PATHS
def test_against_brute_force(spark, inline_rows):
    random.seed(3)

    def text(longest):
        return "".join(random.choice("abA .") for _ in range(random.randint(0, longest)))

    dim = [(i, text(5)) for i in range(40)][5:] + [(99, "bbb")]
    fields = [text(12) for _ in range(300)]
    usable = [(i, n.lower().rstrip()) for i, n in dim if n.strip()]
    dim = [(i, n) for i, n in dim if n.strip()]
    expected = [next((i for i, n in usable if n in f.lower().rstrip()), -1) for f in fields]
    assert look(spark, dim, fields, default=-1, inline_rows=inline_rows) == expected


@PATHS
def test_whole_long_fields_are_searched(spark, inline_rows):
    long = "x" * 20000
    fields = [long + "acme", long, "y" * 64 + "bolt " + long, "acme" + long + "Bolt  "]
    assert look(spark, [(1, "bolt"), (2, "acme")], fields, inline_rows=inline_rows) == [2, None, 1, 1]


def test_every_row_stays(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "field string")
    dim = spark.createDataFrame([(1, "x"), (2, "x")], "id int, name string")
    for inline_rows in (64, 0):
        found = lookup_contains(df, "field", dim, "name", "id", "id", "found", inline_rows=inline_rows)
        assert rows(found) == [(None, None), ("x", 1), ("x", 1)]


@PATHS
def test_rows_without_id_or_rank(spark, inline_rows):
    dim = spark.createDataFrame(
        [(None, "acme", 1), (7, "north", 2), (9, "north", None), (8, "south", None), (6, "south", None)],
        "id int, name string, place int",
    )
    df = spark.createDataFrame([("acme north",), ("acme",), ("south",), (None,)], "field string")
    found = lookup_contains(df, "field", dim, "name", "id", "place", "found", default=35, inline_rows=inline_rows)
    assert rows(found) == [(None, 35), ("acme", 35), ("acme north", 7), ("south", 6)]


def test_a_dimension_of_any_text_lengths(spark):
    random.seed(11)

    def text(alphabet, longest):
        return "".join(random.choice(alphabet) for _ in range(random.randint(1, longest)))

    # Many texts share their pieces; fields repeat the same piece very often.
    dim = [(i, "aab" * random.randint(0, 3) + text("abñ", 6)) for i in range(200)]
    fields = ["aab" * 300 + text("abñ", 8) for _ in range(40)] + [text("abñ🙂", 30) for _ in range(200)]
    expected = [next((i for i, n in sorted(dim) if n in f), -1) for f in fields]
    assert look(spark, dim, fields, default=-1, inline_rows=0) == expected


def test_one_row_per_character_and_no_product(spark):
    df = spark.createDataFrame([("a field of some length",)] * 50, "field string")
    dim = spark.createDataFrame([(i, "x" * i + "field") for i in range(90)], "id int, name string")
    found = lookup_contains(df, "field", dim, "name", "id", "id", "found")
    assert {r.found for r in found.collect()} == {0}
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
