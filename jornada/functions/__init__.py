from jornada.functions.arguments import check_date_range, parse_order
from jornada.functions.clean import (
    blank_if_null,
    day_first_date,
    decimal_comma,
    first_characters,
    iso_date,
    null_if_blank,
    right_trim,
    to_utc,
    zero_if_null,
)
from jornada.functions.nested import custom_field, quoted_token, tag_names
from jornada.functions.time import day_spine, duration_hours, hour_minute, in_date_range, seconds_to_hours

__all__ = [
    "blank_if_null",
    "check_date_range",
    "custom_field",
    "day_first_date",
    "day_spine",
    "decimal_comma",
    "duration_hours",
    "first_characters",
    "hour_minute",
    "in_date_range",
    "iso_date",
    "null_if_blank",
    "parse_order",
    "quoted_token",
    "right_trim",
    "seconds_to_hours",
    "tag_names",
    "to_utc",
    "zero_if_null",
]
