"""Checks of user arguments, made on the driver before any plan is built."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def parse_day(text: str) -> date:
    if not _ISO_DAY.fullmatch(text or ""):
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return date.fromisoformat(text)


def check_date_range(from_date: str, to_date: str) -> tuple[date, date]:
    first, last = parse_day(from_date), parse_day(to_date)
    if first > last:
        raise ValueError(f"from_date {from_date} is after to_date {to_date}")
    return first, last


def parse_order(text: str, allowed: Iterable[str]) -> list[Column]:
    """``"field1 asc, field2 desc"`` -> sort columns; nulls come last both ways."""
    allowed = set(allowed)
    order = []
    for part in text.split(","):
        words = part.split()
        if len(words) not in (1, 2) or words[0] not in allowed:
            raise ValueError(f"cannot order by {part.strip()!r}; known fields: {sorted(allowed)}")
        direction = words[1].lower() if len(words) == 2 else "asc"
        if direction not in ("asc", "desc"):
            raise ValueError(f"order must be asc or desc, not {words[1]!r}")
        field = F.col(words[0])
        order.append(field.asc_nulls_last() if direction == "asc" else field.desc_nulls_last())
    return order
