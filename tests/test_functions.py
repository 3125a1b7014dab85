from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jornada.functions import (
    check_date_range,
    custom_field,
    day_first_date,
    day_spine,
    decimal_comma,
    duration_hours,
    first_characters,
    in_date_range,
    iso_date,
    parse_order,
    quoted_token,
    right_trim,
    seconds_to_hours,
    tag_names,
    to_utc,
    zero_if_null,
)
from jornada.functions.clean import WHITESPACE


def values(spark, data, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_decimal_comma(spark):
    assert values(spark, ["12,5", "7.25", None, "abc"], "string", decimal_comma) == [12.5, 7.25, None, None]


def test_decimal_comma_passes_numbers_through(spark):
    assert values(spark, [12.5, None], "double", decimal_comma) == [12.5, None]


def test_day_first_date_mixes_formats(spark):
    written = ["31/12/2024", "01/02/2024", "1/2/2024", "2024-03-04", "31-12-2024", "", "soon", None]
    expected = [date(2024, 12, 31), date(2024, 2, 1), date(2024, 2, 1), date(2024, 3, 4), date(2024, 12, 31)]
    assert values(spark, written, "string", day_first_date) == [*expected, None, None, None]


def test_day_first_date_takes_more_shapes(spark):
    written = ["2024-01-05T00:00:00", "2024-01-05T23:30:00+02:00", "5.1.2024", "05/01/24", " 05/01/2024 ", "01/17/2024"]
    assert values(spark, written, "string", day_first_date) == [date(2024, 1, 5)] * 5 + [None]


def test_iso_date_reads_month_first(spark):
    assert values(spark, ["05/17/1990", "17/05/1990", "x"], "string", iso_date) == [date(1990, 5, 17)] * 2 + [None]


def test_offset_moves_the_utc_date(spark):
    assert values(spark, ["2024-02-01T00:30:00+01:00", "never"], "string", iso_date) == [date(2024, 1, 31), None]


def test_to_utc(spark):
    parsed = values(spark, ["2024-02-01T00:30:00+01:00"], "string", lambda c: to_utc(c).cast("string"))
    assert parsed == ["2024-01-31 23:30:00"]


def test_right_trim_drops_all_whitespace_on_the_right_only(spark):
    texts = ["  a b \t\n ", "", " \u3000", "a\u00a0\x1f\u2028", "a\u200b"]
    assert values(spark, [*texts, None], "string", right_trim) == [*[t.rstrip() for t in texts], None]
    assert "".join(c for c in map(chr, range(0x110000)) if c.isspace()) == WHITESPACE


def test_zero_if_null(spark):
    assert values(spark, ["3", None, "x"], "string", lambda c: zero_if_null(c, "int")) == [3, 0, 0]


def test_first_characters(spark):
    assert values(spark, ["ñ" * 300, "abc", None], "string", first_characters) == ["ñ" * 200, "abc", None]


def test_custom_field_takes_the_first_match(spark):
    data = [[], [("cf_rea", "X")], [("other", "Z"), ("cf_rea", "X"), ("cf_rea", "Y")], None]
    kind = "array<struct<slug:string,value:string>>"
    assert values(spark, data, kind, lambda c: custom_field(c, "cf_rea")) == [None, "X", "X", None]


def test_tag_names_keep_list_order(spark):
    data = [[], [("b",)], [("b",), ("a",)], None]
    assert values(spark, data, "array<struct<name:string>>", tag_names) == ["", "b", "b,a", ""]


def test_quoted_token(spark):
    assert values(spark, ['{"label":"Ann"}', "plain", None], "string", quoted_token) == ["Ann", None, None]


def test_durations(spark):
    data = [
        (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9, 30)),
        (datetime(2024, 1, 1, 23, 30), datetime(2024, 1, 2, 0, 15)),
        (datetime(2024, 1, 1, 8), None),
    ]
    df = spark.createDataFrame(data, "a timestamp, b timestamp")
    assert [r[0] for r in df.select(duration_hours(F.col("a"), F.col("b"))).collect()] == [1.5, 0.75, None]
    assert values(spark, [5400, None], "bigint", seconds_to_hours) == [1.5, None]


def test_day_spine_is_inclusive(spark):
    days = [r[0] for r in day_spine(spark, date(2023, 12, 30), date(2024, 1, 2)).orderBy("date").collect()]
    assert days == [date(2023, 12, 30), date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 2)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_date_range_includes_the_whole_last_day(spark, kind):
    data = [("2024-01-04 23:59:59",), ("2024-01-05 00:00:00",), ("2024-01-06 23:59:59.999999",), ("2024-01-07",), (None,)]
    df = spark.createDataFrame(data, "t string").select(F.col("t").cast(kind).alias("t"))
    chosen = in_date_range(df, "t", date(2024, 1, 5), date(2024, 1, 6))
    assert [r[0] for r in chosen.select(F.to_date("t")).collect()] == [date(2024, 1, 5), date(2024, 1, 6)]


@pytest.mark.parametrize("bad", [("2024-13-01", "2024-12-01"), ("01/02/2024", "2024-02-03"), ("2024-02-02", "2024-02-01")])
def test_bad_date_arguments(bad):
    with pytest.raises(ValueError):
        check_date_range(*bad)


@pytest.mark.parametrize("bad", ["", "salary", "name up", "name asc desc", "name; drop"])
def test_bad_order(spark, bad):
    with pytest.raises(ValueError):
        parse_order(bad, ["name", "id"])
