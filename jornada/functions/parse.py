"""Cleaning rules that say why a value could not be read.

Each gives a struct (value, reason): the reason is null where the value was read,
and where there was nothing to read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from jornada.functions.clean import (
    DATE_AND_TIME,
    DAY_FIRST_FORMATS,
    day_first_date,
    decimal_comma,
    iso_date,
    to_utc,
)

# The reasons.
NO_FORMAT, NO_DAY = "no known date format", "no such day"
NO_NUMBER, NO_MOMENT, NO_DATE = "not a number", "not a point in time", "not a date"


def parsed(text: Column, value: Column, reason: Column | str) -> Column:
    """The value, and the reason where the text is not blank and yet has none."""
    unread = value.isNull() & (F.trim(text) != "")
    return F.struct(value.alias("value"), F.when(unread, F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))


def parsed_day_first(text: Column) -> Column:
    """A date of any written form, day first; a date that does not exist is told from a text that is no date."""
    shaped = F.regexp_replace(F.trim(text), DATE_AND_TIME, "$1")
    known = F.lit(False)
    for shape in DAY_FIRST_FORMATS:
        known = known | shaped.rlike(shape)
    return parsed(text, day_first_date(text), F.when(known, NO_DAY).otherwise(NO_FORMAT))


def parsed_iso_date(text: Column) -> Column:
    return parsed(text, iso_date(text), NO_DATE)


def parsed_moment(text: Column) -> Column:
    return parsed(text, to_utc(text), NO_MOMENT)


def parsed_decimal(text: Column) -> Column:
    """A number with a comma or a point."""
    return parsed(text, decimal_comma(text), NO_NUMBER)


def errors(rules: Mapping[str, tuple[Column, Column]]) -> Column:
    """What could not be read of a row: an array of (field, reason, text).

    ``rules`` has, by field, the text and its struct (value, reason).
    """
    found = [
        F.struct(F.lit(name).alias("field"), result["reason"].alias("reason"), text.cast("string").alias("text"))
        for name, (text, result) in rules.items()
    ]
    return F.filter(F.array(*found), lambda x: x["reason"].isNotNull())
