"""Cell edits and new employees as loads: validated, rejected with a reason, merged, and safe to repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.functions.parse import errors, parsed_moment
from jornada.operators.boards import CELL_KEY
from jornada.operators.latest import latest_per_key
from jornada.operators.quality import request_body
from jornada.plans.audit import Audit, audited
from jornada.schemas import REQUIRED_EMPLOYEE_FIELDS
from jornada.session import use_utc
from jornada.sources.quarantine import error
from jornada.sources.tables import append_new_rows, merge_into, read_table

# The reasons, and the columns of an edit.
MISSING, KNOWN, REPEATED = "missing", "known employee", "repeated employee"
EDIT = ("edit_id", *CELL_KEY, "value", "edited_at")
EMPLOYEE_KEY = ("companyId", "nid")


def missing(required: Sequence[str]) -> Column:
    """One error per required field that is null or empty."""
    none = F.lit(None).cast("string")
    empty = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", error(F.lit(c), MISSING, none)) for c in required]
    return F.array_compact(F.array(*empty))


def load_cell_edits(
    spark: SparkSession, warehouse: str, edits: DataFrame, load_id: str | None = None, most_rejected: float = 1.0
) -> dict[str, int]:
    """Apply cell edits (``EDIT`` columns, the moment as text) to the table ``board_cells``.

    Edits without id, cell or moment are rejected. The others are logged once by
    id and then merged, each cell guarded by moment and id of its last edit. So
    edits may come in any order and any number of times, and a load that dies
    between the log and the cells is made good by running it again.
    """

    def load(audit: Audit) -> dict[str, int]:
        given = edits.select(*EDIT)
        moment = parsed_moment(F.col("edited_at"))
        found = F.concat(missing([c for c in EDIT if c != "value"]), errors({"edited_at": (F.col("edited_at"), moment)}))
        valid = audit.accept_valid(given, "cell_edits", found)
        valid = valid.withColumn("edited_at", parsed_moment(F.col("edited_at"))["value"])
        valid = latest_per_key(valid, ["edit_id"], "edited_at", "value")
        append_new_rows(spark, f"{warehouse}/cell_edit_log", valid, ["edit_id"])
        # What the log says of an id counts, also for a cell.
        logged = read_table(spark, f"{warehouse}/cell_edit_log").join(valid.select("edit_id"), "edit_id", "left_semi")
        last = latest_per_key(logged.select(*EDIT), CELL_KEY, "edited_at", "edit_id")
        return merge_into(spark, f"{warehouse}/board_cells", last, CELL_KEY, version=("edited_at", "edit_id"))

    use_utc(spark)
    return audited(spark, warehouse, "board_cells", load, load_id, most_rejected)


def load_new_employees(
    spark: SparkSession, warehouse: str, new: DataFrame, load_id: str | None = None, most_rejected: float = 1.0
) -> dict[str, int]:
    """Insert employees into the table ``employee_requests``, with an id and the request's JSON text.

    Rejected are rows that lack a required field, that repeat another row's
    company and national id with other values, and that the table knows with
    other values. A row that the table has as it is changes nothing.
    """
    key = list(EMPLOYEE_KEY)

    def load(audit: Audit) -> dict[str, int]:
        rows = new.withColumn("body", request_body(new)).dropDuplicates(["body"])
        rows = audit.accept_valid(rows, "new_employees", missing(REQUIRED_EMPLOYEE_FIELDS))
        # The first body of a key, summed up in the map tasks, and the table's body.
        first = rows.groupBy(*key).agg(F.min("body").alias("_first"))
        known = read_table(spark, f"{warehouse}/employee_requests") if audit.has("employee_requests") else first.limit(0)
        known = known.select(*key, F.col("body" if "body" in known.columns else "_first").alias("_known"))
        told = rows.join(first, key).join(known, key, "left")
        kept = F.coalesce("_known", "_first")
        reason = F.when(F.col("_known").isNotNull(), KNOWN).otherwise(REPEATED)
        found = F.when(F.col("body") != kept, F.array(error(None, reason, F.col("body")))).otherwise(F.array())
        valid = audit.accept_valid(told, "new_employees", found, count_read=False)
        valid = valid.drop("_first", "_known")
        return merge_into(spark, f"{warehouse}/employee_requests", valid, key, surrogate="employee_id")

    return audited(spark, warehouse, "employee_requests", load, load_id, most_rejected)
