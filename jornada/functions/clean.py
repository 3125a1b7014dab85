"""Cleaning rules for single values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape of a date text -> its format; day first, or ISO. Testing the shape costs
# far less than a failed parse.
DAY_FIRST_FORMATS = {
    r"^\d{1,2}/\d{1,2}/\d{4}$": "d/M/yyyy",
    r"^\d{1,2}-\d{1,2}-\d{4}$": "d-M-yyyy",
    r"^\d{1,2}\.\d{1,2}\.\d{4}$": "d.M.yyyy",
    r"^\d{1,2}/\d{1,2}/\d{2}$": "d/M/yy",
    r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}:\d{2}$": "d/M/yyyy HH:mm:ss",
}
# A date and a time with or without an offset: the date as written counts.
DATE_AND_TIME = r"^(\d{4}-\d{1,2}-\d{1,2})[T ]\d{1,2}:\d{2}.*$"
MONTH_FIRST = r"^\d{1,2}/\d{1,2}/\d{4}$"


# The characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def right_trim(text: Column) -> Column:
    """Drop trailing whitespace of every kind; plain ``rtrim`` drops blanks only."""
    return F.rtrim(text, F.lit(WHITESPACE))


def blank_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def null_if_blank(text: Column) -> Column:
    return F.when(text != "", text)


def zero_if_null(value: Column, type_name: str) -> Column:
    """Null, and text that is no number, become 0 of the given type."""
    return F.coalesce(value.try_cast(type_name), F.lit(0).cast(type_name))


def decimal_comma(text: Column) -> Column:
    """``12,5`` and ``12.5`` -> 12.5; null, and text that is no number, -> null."""
    return F.replace(text.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def first_characters(text: Column, n: int = 200) -> Column:
    return F.substring(text, 1, n)


def to_utc(text: Column) -> Column:
    """ISO text, with or without an offset, to a timestamp (the session is in UTC)."""
    return F.try_to_timestamp(text)


def iso_date(text: Column) -> Column:
    """An ISO text's UTC date; ``5/17/1990`` is read month first, and day first where that gives no date."""
    month_first = [
        F.when(F.trim(text).rlike(MONTH_FIRST), F.try_to_timestamp(F.trim(text), F.lit(f))) for f in ("M/d/yyyy", "d/M/yyyy")
    ]
    return F.to_date(F.coalesce(to_utc(text), *month_first))


def day_first_date(text: Column) -> Column:
    """Mixed formats, day before month, with blanks around; text in no known format becomes null."""
    text = F.trim(text)
    shaped = F.regexp_replace(text, DATE_AND_TIME, "$1")
    parsed = [
        F.when(shaped.rlike(shape), F.try_to_timestamp(shaped, F.lit(written)))
        for shape, written in DAY_FIRST_FORMATS.items()
    ]
    return F.to_date(F.coalesce(*parsed))
