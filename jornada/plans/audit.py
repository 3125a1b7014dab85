"""Loads that keep what they reject and tell what they did.

``Audit`` reads the landing zone for a job: rejected records go to the table
``load_rejects``, and one row per load, with all its counts, to ``load_audit``.
Both take a row once, however often a load is repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.functions.parse import errors
from jornada.session import checkpoint_folder
from jornada.sources.quarantine import REJECT, REJECT_TYPE, read_checked, reject_rows, split_once
from jornada.sources.tables import ACTIONS, STALE, append_new_rows, has_table

REJECT_KEY = ("entity", "tenant", "date", "digest")
AUDIT = (
    "load_id string, name string, started timestamp, ended timestamp, read bigint, rejected bigint, "
    + ", ".join(f"`{a}` bigint" for a in (*ACTIONS, STALE))
)


class Audit:
    """One load: what it reads, rejects and writes.

    ``most_rejected`` is the share of rejected rows from which on a read fails,
    before anything is merged.
    """

    def __init__(self, spark: SparkSession, warehouse: str, load_id: str | None = None, most_rejected: float = 1.0):
        self.spark, self.warehouse, self.most_rejected = spark, warehouse, most_rejected
        self.load_id = load_id or uuid.uuid4().hex
        self.counts = {"read": 0, "rejected": 0}
        self._started = datetime.now(timezone.utc)

    def read(self, spark: SparkSession, root: str, entity: str, **asked) -> DataFrame:
        """As ``read_landing``, without the records that cannot be read."""
        return self.accept(read_checked(spark, root, entity, **asked), entity)

    def has(self, name: str) -> bool:
        return has_table(self.spark, f"{self.warehouse}/{name}")

    def accept(self, checked: DataFrame, entity: str, count_read: bool = True) -> DataFrame:
        """The rows without ``reject``; the others are stored with their errors.

        Where rows are checked a second time, ``count_read=False`` counts them once.
        """
        folder = f"{checkpoint_folder(self.spark)}/loads/{self.load_id}/{entity}-{uuid.uuid4().hex}"
        accepted, rejected, counts = split_once(checked, folder, self.most_rejected)
        self.counts["read"] += counts["read"] if count_read else 0
        self.counts["rejected"] += counts["rejected"]
        if counts["rejected"]:
            append_new_rows(self.spark, f"{self.warehouse}/load_rejects", reject_rows(rejected, entity), REJECT_KEY)
        return accepted

    def accept_parsed(
        self, rows: DataFrame, entity: str, rules: Mapping[str, tuple[Column, Column]], count_read: bool = True
    ) -> DataFrame:
        """The rows all of whose texts can be read; see ``functions.parse``."""
        return self.accept_valid(rows, entity, errors(rules), count_read)

    def accept_valid(self, rows: DataFrame, entity: str, found: Column, count_read: bool = True) -> DataFrame:
        """The rows whose array of errors is empty."""
        reject = F.when(F.size(found) > 0, F.struct(found.alias("errors"), F.to_json(F.struct("*")).alias("text")))
        return self.accept(rows.withColumn(REJECT, reject.cast(REJECT_TYPE)), entity, count_read)

    def reject(self, rows: DataFrame, entity: str, reason: str) -> None:
        """Store rows that a job has refused as a whole; they count as rejected, and were read before."""
        told = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(reason).alias("reason"), F.lit(None).cast("string").alias("text")))
        reject = F.struct(told.alias("errors"), F.to_json(F.struct("*")).alias("text")).cast(REJECT_TYPE)
        refused = reject_rows(rows.withColumn(REJECT, reject), entity)
        append_new_rows(self.spark, f"{self.warehouse}/load_rejects", refused, REJECT_KEY)
        self.counts["rejected"] += refused.count()

    def close(self, name: str, actions: Mapping[str, int]) -> dict[str, int]:
        """Write the load's row and return all counts."""
        found = {**self.counts, **dict.fromkeys((*ACTIONS, STALE), 0), **actions}
        row = (self.load_id, name, self._started, datetime.now(timezone.utc), *[found[c] for c in ("read", "rejected", *ACTIONS, STALE)])
        frame = self.spark.createDataFrame([row], AUDIT)
        append_new_rows(self.spark, f"{self.warehouse}/load_audit", frame, ["load_id", "name"])
        return found


def audited(
    spark: SparkSession,
    warehouse: str,
    name: str,
    load: Callable[[Audit], dict[str, int]],
    load_id: str | None = None,
    most_rejected: float = 1.0,
) -> dict[str, int]:
    """Run a load under an audit; ``load`` gets it, reads through it and returns the counts of its merge."""
    audit = Audit(spark, warehouse, load_id, most_rejected)
    return audit.close(name, load(audit))
