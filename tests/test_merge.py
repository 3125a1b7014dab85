import random

import pytest
from conftest import rows

from jornada.operators import merge

TARGET = [(1, "a", "x"), (2, "b", None), (3, "c", "z")]
SOURCE = [(1, "a", "x"), (2, "b", "y"), (4, "d", None), (3, "c", None)]
COLUMNS = "k int, v string, w string"


def test_upsert_actions(spark):
    target, source = spark.createDataFrame(TARGET, COLUMNS), spark.createDataFrame(SOURCE, COLUMNS)
    classified = merge.classify_changes(target, source, ["k"])
    assert rows(classified) == [
        (1, "a", "x", "unchanged"),
        (2, "b", "y", "update"),
        (3, "c", None, "update"),
        (4, "d", None, "insert"),
    ]
    again = merge.classify_changes(merge.upsert(target, source, ["k"]), source, ["k"])
    assert {r.action for r in again.collect()} == {"unchanged"}
    assert rows(merge.count_actions(classified)) == [("insert", 1), ("unchanged", 1), ("update", 2)]


def test_upsert_keeps_target_rows_columns_and_surrogates(spark):
    target = spark.createDataFrame([(70, 1, "a"), (71, 9, "gone")], "sid bigint, k int, v string")
    source = spark.createDataFrame([("b", 1), ("c", 2)], "v string, k int")
    merged = merge.upsert(target, source, ["k"], surrogate="sid")
    by_key = {r.k: r for r in merged.collect()}
    assert by_key[1].sid == 70 and by_key[1].v == "b"
    assert by_key[9].sid == 71 and by_key[9].v == "gone"
    expected = spark.createDataFrame([(2,)], "k int").select(merge.key_hash(["k"])).first()[0]
    assert by_key[2].sid == expected
    assert merged.columns == ["sid", "k", "v"]


def test_upsert_aligns_types(spark):
    target = spark.createDataFrame([("2024-01-05", 1)], "d string, v int").selectExpr("cast(d as date) d", "v")
    source = spark.createDataFrame([("2024-01-05", 2)], "d string, v int")
    assert [r.v for r in merge.upsert(target, source, ["d"]).collect()] == [2]


def test_upsert_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        merge.upsert(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 2)], "k int, x int"), ["k"])


def test_null_keys_are_equal(spark):
    existing = spark.createDataFrame([(None, 1), (None, 1), (5, 2)], "k int, v int")
    incoming = spark.createDataFrame([(None, 7), (6, 8), (5, 9)], "k int, v int")
    for repeated in (True, False):
        assert rows(merge.rows_with_new_key(incoming, existing, ["k"], repeated)) == [(6, 8)]
        assert rows(merge.rows_with_known_key(incoming, existing, ["k"], repeated)) == [(None, 7), (5, 9)]
    merged = merge.upsert(spark.createDataFrame([(None, 1)], "k int, v int"), incoming, ["k"])
    assert rows(merged) == [(None, 7), (5, 9), (6, 8)]


def test_new_and_known_make_up_the_incoming_rows(spark):
    incoming = spark.range(100).selectExpr("id % 40 as a", "cast(id % 3 as string) as b", "id")
    existing = spark.range(60).selectExpr("id % 20 as a", "cast(id % 4 as string) as b")
    new = merge.rows_with_new_key(incoming, existing, ["a", "b"], repeated=True)
    known = merge.rows_with_known_key(incoming, existing, ["a", "b"], repeated=True)
    assert rows(new.union(known)) == rows(incoming)


def test_append_new_keeps_incoming_duplicates(spark):
    existing = spark.createDataFrame([(1, "a")], "k int, v string")
    incoming = spark.createDataFrame([(1, "x"), (2, "b"), (2, "c")], "k int, v string")
    once = merge.append_new(existing, incoming, ["k"])
    assert rows(once) == [(1, "a"), (2, "b"), (2, "c")]
    assert rows(merge.append_new(once, incoming, ["k"])) == rows(once)


def test_delete_by_key(spark):
    target = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(merge.delete_by_key(target, spark.createDataFrame([(2,), (2,), (3,)], "k int"), ["k"])) == [(None,), (1,)]


def test_repeated_keys_are_refused(spark):
    with pytest.raises(ValueError, match="not unique"):
        merge.assert_unique(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), ["k"])


def test_upsert_against_a_dictionary(spark):
    random.seed(11)
    schema = "a int, b string, v int, w string"

    def table(n):
        keys = {(random.choice([None, *range(12)]), random.choice([None, "x", "y", "z"])) for _ in range(n)}
        return {k: (random.choice([None, 1, 2]), random.choice([None, "p", "q"])) for k in keys}

    target, source = table(30), table(30)
    frames = [spark.createDataFrame([(*k, *v) for k, v in t.items()], schema) for t in (target, source)]
    merged = merge.upsert(*frames, ["a", "b"])
    assert rows(merged) == rows(spark.createDataFrame([(*k, *v) for k, v in (target | source).items()], schema))
    actions = {(r.a, r.b): r.action for r in merge.classify_changes(*frames, ["a", "b"]).collect()}
    for key in target | source:
        if key not in target:
            assert actions[key] == "insert"
        elif key not in source:
            assert actions[key] == "keep"
        else:
            assert actions[key] == ("unchanged" if target[key] == source[key] else "update")
