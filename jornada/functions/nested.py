"""Values out of arrays, structs and small JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def custom_field(fields: Column, slug: str) -> Column:
    """Value of the first ``{slug, value}`` entry with this slug, else null."""
    return F.get(F.filter(fields, lambda f: f["slug"] == F.lit(slug)), F.lit(0))["value"]


def tag_names(tags: Column) -> Column:
    """Comma-joined names in list order; no tags give an empty text."""
    return F.coalesce(F.array_join(F.transform(tags, lambda t: t["name"]), ","), F.lit(""))


def quoted_token(text: Column, index: int = 3) -> Column:
    """Piece ``index`` of a text split at double quotes, null when there are fewer."""
    return F.get(F.split(text, '"'), F.lit(index))
