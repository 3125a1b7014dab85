"""An index of row positions in an ordered listing, for pages far down."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.functions import parse_order
from jornada.session import checkpoint_folder
from jornada.sources.files import delete

_PLACE = (1 << 33) - 1


class PositionIndex:
    """The order of a listing, as a stored table of its sort keys alone.

    It is sorted once, by ranges, with the number of rows in each. A page reads
    the part of it where its positions lie, and fetches its rows by their keys:
    no wide row is sorted or copied, and no task gets the rows before the page.
    The index serves any number of pages until ``remove``; used as a context
    manager, it removes itself. Rows are told apart by their keys and a hash of
    all their columns; equal rows follow each other, and each counts.
    """

    def __init__(self, df: DataFrame, order_by: str, tie_break: Sequence[str] = ()):
        order = [*parse_order(order_by, df.columns), *[F.col(c).asc_nulls_last() for c in tie_break]]
        self._keys = list(dict.fromkeys([*[part.split()[0] for part in order_by.split(",")], *tie_break]))
        self._df = df.withColumn("_row", F.xxhash64(*df.columns))
        self.spark: SparkSession = df.sparkSession
        self.folder = f"{checkpoint_folder(self.spark)}/positions/{uuid.uuid4().hex}"
        narrow = self._df.select(*self._keys, "_row").orderBy(*order, "_row")
        narrow = narrow.withColumn("_at", F.monotonically_increasing_id())
        narrow.write.parquet(self.folder)
        self._index = self.spark.read.schema(narrow.schema).parquet(self.folder)
        # One row per range.
        sizes = self._index.groupBy(F.shiftright("_at", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
        self._parts, self.rows = [], 0
        for part, n in sizes:
            self._parts.append((part, self.rows, n))
            self.rows += n

    def page(self, limit: int, page: int = 1) -> DataFrame:
        """Page ``page`` (from 1) of ``limit`` rows, in order."""
        if limit < 1 or page < 1:
            raise ValueError("limit and page start at 1")
        first = (page - 1) * limit
        inside, place = F.lit(False), F.lit(None).cast("long")
        for part, start, n in self._parts:
            low, high = max(first, start), min(first + limit, start + n)
            if low < high:
                base = (part << 33) - start
                here = (F.col("_at") >= base + low) & (F.col("_at") < base + high)
                inside, place = inside | here, F.when(here, F.col("_at") - base).otherwise(place)
        chosen = self._index.where(inside).withColumn("_place", place)
        keys = chosen.groupBy(*self._keys, "_row").agg(F.min("_place").alias("_place"), F.count("*").alias("_times"))
        # No more keys than the page has rows; stored apart, so that a page outlives the index.
        path = f"{self.folder}.page-{uuid.uuid4().hex}"
        keys.coalesce(1).write.parquet(path)
        keys = self.spark.read.schema(keys.schema).parquet(path)
        named = keys.withColumnsRenamed({c: f"_key_{c}" for c in [*self._keys, "_row"]})
        same = F.lit(True)
        for c in [*self._keys, "_row"]:
            same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
        found = self._df.join(named, same).dropDuplicates(["_place"])
        again = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_time")
        return found.select("*", again).orderBy("_place").drop("_row", "_place", "_times", "_time", *named.columns)

    def remove(self) -> None:
        delete(self.spark, self.folder)

    def __enter__(self) -> PositionIndex:
        return self

    def __exit__(self, *_) -> None:
        self.remove()
