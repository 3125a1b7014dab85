"""One row per key: latest record, highest id; and the rows of each key's latest extract."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], updated_at: str, tie_break: str) -> DataFrame:
    """Whole latest row per key; null dates lose, ties go to the highest tie-break.

    ``row_number() = 1`` lets Spark cut every map task's output to one row per
    key before the shuffle (WindowGroupLimit), so a hot key costs no more than
    one row per task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(updated_at).desc_nulls_last(), F.col(tie_break).desc_nulls_last()
    )
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def latest_values(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], updated_at: str, tie_break: str
) -> DataFrame:
    """The same for a few value columns, as an aggregate with map-side combine."""
    newest = F.max_by(F.struct(*values), F.struct(updated_at, tie_break)).alias("_latest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_latest.*")


def last_id_per_key(df: DataFrame, key: str, id_column: str) -> DataFrame:
    """Highest id per key; rows without key are dropped."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(id_column).alias(id_column))


def latest_generation(df: DataFrame, of: Sequence[str], generation: str) -> DataFrame:
    """All rows of the last generation of each key; rows without generation are the oldest one.

    A day that was extracted again replaces the day, whichever records the new
    extract has. The last generations are one row per key, reduced in the map
    tasks, and the rows meet them in a semi join that keeps their order of magnitude.
    """
    names = [*of, generation]
    last = df.groupBy(*of).agg(F.max(generation).alias(generation)).withColumnsRenamed({n: f"_last_{n}" for n in names})
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_last_{n}")) for n in names])
    return df.join(last, same, "left_semi")
