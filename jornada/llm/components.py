"""Connected components of links that stay distributed."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jornada.llm.words import stored

#: So few links are followed to their end in one task; more are contracted first.
IN_ONE_TASK = 100_000


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The move (old, new) of every node of the links to a root of its component."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for given in batches:
        for a, b in zip(given.column(0).to_pylist(), given.column(1).to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    old = list(root)
    yield pa.RecordBatch.from_arrays(
        [pa.array(old, pa.int64()), pa.array([find(x) for x in old], pa.int64())], names=["old", "new"]
    )


def components(links: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """node and label, the smallest node it is connected with, for every node of the links (a, b: long).

    In each round every node moves to the one of its neighbourhood that comes
    first in an order drawn anew for the round, and the links are contracted to
    those. Links within a component vanish; the nodes left are at most about
    half as many each time, in chains as in stars. Once the links are few, one
    task follows them to their end. Each round's moves are written to the
    checkpoint folder, and in the end the moves are followed through. A hot node is summed up before the shuffle, and the joins are
    sort-merge joins whose hot partitions Spark can split.
    """
    first = links.select("a", "b").filter(F.col("a") != F.col("b")).distinct()
    edges = first = stored(first)
    moves: list[DataFrame] = []

    def moved(frame: DataFrame, column: str, move: DataFrame) -> DataFrame:
        found = frame.join(move.hint("merge"), F.col(column) == F.col("old"), "left")
        return found.withColumn(column, F.coalesce("new", column)).drop("old", "new")

    while (left := edges.count()) > 0:
        if left <= in_one_task:
            move = edges.coalesce(1).mapInArrow(_followed, "old long, new long")
            moves.append(stored(move.filter(F.col("old") != F.col("new"))))
            break
        both = edges.union(edges.select("b", "a"))
        order = F.struct(F.xxhash64("b", F.lit(len(moves))).alias("place"), F.col("b"))
        own = F.struct(F.xxhash64("a", F.lit(len(moves))).alias("place"), F.col("a").alias("b"))
        move = both.groupBy("a").agg(F.min(order).alias("least")).select(
            F.col("a").alias("old"), F.least("least", own)["b"].alias("new")
        )
        moves.append(stored(move.filter(F.col("old") != F.col("new"))))
        edges = moved(moved(edges, "a", moves[-1]), "b", moves[-1])
        edges = stored(edges.filter(F.col("a") != F.col("b")).distinct())
    nodes = first.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    for move in moves:
        nodes = moved(nodes, "root", move)
    nodes = stored(nodes)
    least = nodes.groupBy("root").agg(F.min("node").alias("label"))
    return stored(nodes.join(stored(least).hint("merge"), "root").select("node", "label"))
