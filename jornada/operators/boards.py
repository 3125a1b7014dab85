"""Work-board items: names, cell values and cell edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.functions import quoted_token
from jornada.operators.latest import latest_values
from jornada.operators.merge import upsert
from jornada.schemas import BOARD_ASSIGNMENT_COLUMN, BOARD_HOURS_COLUMN

CELL_KEY = ("board_id", "item_id", "column_id")


def board_ids(boards: DataFrame, name: str = "name", board_id: str = "id", arrival: str = "arrival") -> DataFrame:
    """Name -> id; of several boards with one name the last to arrive wins."""
    return boards.groupBy(name).agg(F.max_by(board_id, F.struct(arrival, board_id)).alias(board_id))


def board_items(pages: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Item pages -> ``item_id, name``, one row per item."""
    items = pages.select(arrival, F.explode("items").alias("item")).select(
        F.col("item.id").alias("item_id"), F.col("item.name").alias("name"), arrival
    )
    return items.groupBy("item_id").agg(F.max_by("name", F.struct(arrival, "name")).alias("name"))


def items_of_board(pages: DataFrame, board_id: str, arrival: str = "arrival") -> DataFrame:
    """Item pages -> ``item_id, name`` of one board, one row per item."""
    return board_items(pages.filter(F.col("board_id") == board_id), arrival)


def cells_of_items(cell_rows: DataFrame, items: DataFrame) -> DataFrame:
    """The cells of the items whose ``item_id`` is given."""
    return cell_rows.join(items.select("item_id"), "item_id", "left_semi")


def cells(item_cells: DataFrame, arrival: str | None = None) -> DataFrame:
    """Nested column values -> one row per cell; ``seq`` is the place in the list.

    With an arrival column there is also ``arrival_seq``, which orders the cells
    of several extracts of an item.
    """
    order = [F.col(arrival).alias("arrival")] if arrival else []
    listed = item_cells.select("id", *order, F.posexplode("column_values").alias("seq", "cell"))
    both = [F.struct("arrival", "seq").alias("arrival_seq")] if arrival else []
    return listed.select(
        F.col("id").alias("item_id"),
        F.col("cell.column.id").alias("column_id"),
        F.col("cell.value").alias("value"),
        "seq",
        *both,
    )


def pivot_cells(
    cell_rows: DataFrame,
    order: str = "seq",
    hours_column: str = BOARD_HOURS_COLUMN,
    assignment_column: str = BOARD_ASSIGNMENT_COLUMN,
    assignee: Column | None = None,
) -> DataFrame:
    """Cells -> ``item_id, hours, assignment`` (defaults "0" and "").

    The last non-empty cell of a column counts. One aggregation per item with
    map-side combine; no list of cells is built.
    """
    value = F.col("value")
    filled = value.isNotNull() & (value != "")

    def last(column_id: str, result: Column) -> Column:
        this_cell = filled & (F.col("column_id") == column_id)
        return F.max_by(result, F.when(this_cell, F.col(order)))

    assigned = quoted_token(value) if assignee is None else assignee
    return cell_rows.groupBy("item_id").agg(
        F.coalesce(last(hours_column, value), F.lit("0")).alias("hours"),
        F.coalesce(last(assignment_column, assigned), F.lit("")).alias("assignment"),
    )


def items_with_cells(items: DataFrame, cell_rows: DataFrame, **pivot) -> DataFrame:
    """Items with name, hours and assignment; items without cells get the defaults.

    The cells are reduced to one row per item before they meet the items.
    """
    return items.join(pivot_cells(cell_rows, **pivot), "item_id", "left").na.fill({"hours": "0", "assignment": ""})


def apply_cell_edits(
    cell_table: DataFrame, edits: DataFrame, edited_at: str = "edited_at", tie_break: str = "value"
) -> DataFrame:
    """Set cells: the last edit per (board, item, column) wins, other cells stay."""
    last = latest_values(edits, list(CELL_KEY), ["value"], edited_at, tie_break)
    return upsert(cell_table, last, list(CELL_KEY))
