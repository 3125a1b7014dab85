"""Merkle manifest of a dataset: a hash tree per group, a proof per row, and one root over all groups.

Each row is a leaf: the SHA-256 of its columns, each written with its length.
The leaves of a group, in order, are hashed in runs of two, level by level, to
the group's subroot; the subroots, in order of their groups, likewise give the
root. A row's proof are its ancestors' siblings, from the leaf to the root.

Method: a level is a pair of lag and lead columns. The row of a node's first
leaf stands for the node; at level k its neighbours are 2^k rows away, masked
by its slot in the run and by the run's length, and rows of first children hash
the parent. Windows span aligned blocks of 2^HEIGHT leaves, so that no window
holds a whole group; the blocks' hashes are the leaves of the next round.

Defined results: a null column is written as "-", so it differs from an empty
text. Rows without group are a group of their own, the first one. Rows of one
group and id follow each other by their leaf's hash, equal rows in any order,
rows without id before all others. A lone leaf is its group's subroot, and a
lone subroot the root. An empty table gives no rows. Other columns of the table
are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jornada.llm.words import partitions, stored

#: Levels that one round of windows builds, in blocks of 2 ** HEIGHT nodes.
HEIGHT = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PLACE = (1 << 33) - 1


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: dict[str, Column] | None = None) -> Column:
    """Hash of a row of documents; `columns` gives other values for some of its columns."""
    values = {name: F.col(name) for name in COLUMNS} | (columns or {})
    texts = [value.cast("string") for value in values.values()]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds `_pos`, the place in the order among the nodes of one `_tree`, and `_height`, the levels above them.

    Nodes are dealt out by ranges, however many a tree has; only counts per
    range and tree are summed up.
    """
    ranged = nodes.repartitionByRange(partitions(nodes.sparkSession), "_tree", *order).sortWithinPartitions("_tree", *order)
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(_PLACE)})
    parts = ranged.groupBy("_tree", "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    tree = Window.partitionBy("_tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_n").over(tree)
    parts = stored(
        parts.select(
            "_tree",
            "_part",
            (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_shift"),
            F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0).alias("_height"),
        )
    )
    found = ranged.join(parts, ["_tree", "_part"]).withColumn("_pos", F.col("_at") + F.col("_shift"))
    return stored(found.drop("_at", "_part", "_shift"))


def climbed(nodes: DataFrame) -> DataFrame:
    """Nodes with `_steps`, the siblings (left, right) on HEIGHT levels, and, at a block's first row, its hash `_up`."""
    block = Window.partitionBy("_tree", F.shiftright("_pos", HEIGHT)).orderBy("_pos")
    own = nodes.columns
    nodes, sides = nodes.withColumn("_up", F.col("_hash")), []
    for level in range(HEIGHT):
        width = 1 << level
        open_ = F.lit(level) < F.col("_height")
        first = (F.col("_pos") % width == 0) & open_
        slot = F.shiftright("_pos", level).bitwiseAND(1)
        nodes = nodes.select(
            "*",
            F.when(first & (slot == 1), F.lag("_up", width).over(block)).alias("_before"),
            F.when(first & (slot == 0), F.lead("_up", width).over(block)).alias("_after"),
        )
        left, right = F.coalesce("_before", F.lit("")), F.coalesce("_after", F.lit(""))
        parent = F.when(open_, digest(F.col("_up"), right)).otherwise(F.col("_up"))
        nodes = nodes.select(
            *own,
            *sides,
            F.when(first, F.struct(left.alias("left"), right.alias("right"))).alias(f"_side{level}"),
            F.when(F.col("_pos") % (2 * width) == 0, parent).alias("_up"),
        )
        sides.append(f"_side{level}")
    # What stands at a node's first row holds for all leaves below it; levels that the tree lacks stay null.
    running = block.rowsBetween(Window.unboundedPreceding, 0)
    steps = F.array(*[F.last(side, True).over(running) for side in sides])
    return nodes.select(*own, "_up", F.array_compact(steps).alias("_steps"))


def proven(nodes: DataFrame) -> DataFrame:
    """Numbered nodes with `_steps` up to the root of their tree, and `_top`, that root."""
    most = nodes.agg(F.max("_height")).first()[0] or 0
    below = climbed(nodes)
    blocks = below.where(F.col("_pos") % (1 << HEIGHT) == 0).select(
        "_tree", F.shiftright("_pos", HEIGHT).alias("_pos"), F.col("_up").alias("_hash"), (F.col("_height") - HEIGHT).alias("_height")
    )
    blocks = stored(blocks)
    if most > HEIGHT:
        above = proven(blocks)
    else:
        above = blocks.withColumns({"_steps": F.array().cast("array<struct<left: string, right: string>>"), "_top": F.col("_hash")})
    above = above.select("_tree", F.col("_pos").alias("_block"), F.col("_steps").alias("_more"), "_top")
    below = below.withColumn("_block", F.shiftright("_pos", HEIGHT)).join(above, ["_tree", "_block"])
    return below.withColumn("_steps", F.concat("_steps", "_more")).drop("_block", "_more", "_up")


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, start, lambda own, step: digest(step["left"], own, step["right"]))


def proof_text(steps: Column) -> Column:
    """All siblings of a proof, level by level."""
    return F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(docs: DataFrame, **also: Column) -> DataFrame:
    """doc_id, leaf, subroot, root and proof (siblings as left and right, level by level) of each document.

    `also` names columns that are computed from the whole row and carried along.
    """
    # Null comes first, then the languages in order of their bytes.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("_tree")
    rows = docs.select(F.col("doc_id").cast("long"), tree, leaf().alias("_hash"), *[c.alias(n) for n, c in also.items()])
    leaves = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    leaves = proven(numbered(leaves, ["doc_id", "_hash", "_row"]).drop("_row"))

    subroots = leaves.where("_pos = 0").select(F.lit("").alias("_tree"), F.col("_tree").alias("_name"), F.col("_top").alias("_hash"))
    top = proven(numbered(stored(subroots), ["_name"])).select(
        F.col("_name").alias("_tree"), F.col("_steps").alias("_more"), F.col("_top").alias("root")
    )
    found = leaves.withColumnsRenamed({"_hash": "leaf", "_top": "subroot"}).join(stored(top), "_tree")
    proof = F.concat("_steps", "_more").alias("proof")
    return found.select("doc_id", "leaf", "subroot", "root", proof, *also)
