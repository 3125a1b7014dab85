"""Mixing of sources to target weights.

Each row gets a hash-random key. Within each source the keys are cut into
ranges, and the ranges' word totals are summed up in order. The range in which
the source's budget ends is sorted by key, and the running total of its rows
gives the row at which the budget is cut. Rows before the cut are taken whole,
the row at it in part, and as many whole epochs as fit go before that. The cuts,
one per source, are all that the rows are then held against, so no text moves
and a large source is spread over all its ranges.

Defined results: the size of a null text is 0; a null source is a source of its
own, the last; rows with the same id and text stand at the same place, and
share what is left for them evenly if the cut falls there; sources without
words get the target 0; an empty table gives no rows. Columns that have a
result's name are replaced by it, all others are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jornada.llm.words import BLANKS, WORD, or_empty, partitions, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
EPOCHS = 2.0
SEED = 20


def targets(sizes: Sequence[float], weights: Sequence[float], share: float, epochs: float) -> list[float]:
    """Words that the mix takes of each source: by weight, at most `epochs` times its size.

    What a full source cannot take is shared again by weight until none is full.
    """
    found, left, budget = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while left:
        weight = sum(weights[i] for i in sorted(left))
        full = {i for i in left if budget * weights[i] / weight >= epochs * sizes[i]}
        if not full:
            for i in left:
                found[i] = budget * weights[i] / weight
            break
        for i in sorted(full):
            found[i] = epochs * float(sizes[i])
            budget -= found[i]
        left -= full
    return found


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS
) -> DataFrame:
    """One row per source: source, source_size, target.

    Only these totals come to the driver, a row for each source of the mix.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["source_size"] for r in totals]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, epochs)
    rows = [(r["source"], r["source_size"], aim) for r, aim in zip(totals, aims)]
    return sized.sparkSession.createDataFrame(rows, "source string, source_size long, target double")


def _place(frame: DataFrame) -> DataFrame:
    """With the row's place in its source: a hash-random key, and what parts rows of equal keys."""
    return frame.withColumn("__place", F.struct("__key", "doc_id", "__tie"))


def cuts(sized: DataFrame, aims: DataFrame) -> DataFrame:
    """The targets with __whole (epochs), __rest (words beyond them), and the cut: __cut (a place), __left (words), __same (rows).

    One row per source.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("__whole", whole)
    aims = aims.withColumn("__rest", F.round(F.col("target") - F.col("__whole") * F.col("source_size")).cast("long"))
    # The top bits of the key are its range: so many that each range of each source is small.
    bits = max(4, (8 * partitions(sized.sparkSession)).bit_length())
    ranged = sized.withColumn("_range", F.shiftright("__key", 64 - bits))
    by_range = ranged.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    ordered = Window.partitionBy("source").orderBy("_range")
    by_range = by_range.withColumn("_until", F.sum("_words").over(ordered))
    named = F.broadcast(aims.withColumnRenamed("source", "__aim"))
    ending = by_range.join(named, F.col("source").eqNullSafe(F.col("__aim")))
    ending = ending.filter((F.col("_until") >= F.col("__rest")) & (F.col("_until") - F.col("_words") < F.col("__rest")))
    ending = ending.select(
        F.col("source").alias("__aim"), F.col("_range").alias("_of"), (F.col("__rest") - F.col("_until") + F.col("_words")).alias("_need")
    )
    # One range of each source.
    rows = ranged.join(
        F.broadcast(stored(ending)), F.col("source").eqNullSafe(F.col("__aim")) & (F.col("_range") == F.col("_of"))
    )
    rows = _place(rows).groupBy("source", "__place", "_need").agg(F.sum("size").alias("_words"), F.count("*").alias("__same"))
    inside = Window.partitionBy("source").orderBy("__place")
    rows = rows.withColumn("_until", F.sum("_words").over(inside))
    rows = rows.filter((F.col("_until") >= F.col("_need")) & (F.col("_until") - F.col("_words") < F.col("_need")))
    found = rows.select(
        F.col("source").alias("__aim"),
        F.col("__place").alias("__cut"),
        (F.col("_need") - F.col("_until") + F.col("_words")).alias("__left"),
        "__same",
    )
    return stored(aims.join(F.broadcast(found), F.col("source").eqNullSafe(F.col("__aim")), "left").drop("__aim"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = SEED,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The documents with size, source_size, target and taken.

    `taken` is the number of the document's words in the mix, repeats counted.
    `carry` names the input columns to keep (all by default).
    """
    results = ("size", "source_size", "target", "taken")
    names = [c for c in (carry if carry is not None else docs.columns) if c not in results]
    own = [
        F.col("source").cast("string").alias("source"),
        F.regexp_count(or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("__key"),
        F.xxhash64(or_empty()).alias("__tie"),
    ]
    sized = stored(docs.select("doc_id", *own))
    aims = cuts(sized, source_targets(sized, weights, share, epochs))
    # One row per source.
    aims = F.broadcast(aims.withColumnRenamed("source", "__aim"))
    if set(names) <= {"doc_id", "source"}:
        rows = sized
    else:
        rows = docs.select(*[c for c in names if c != "source"], *([] if "doc_id" in names else ["doc_id"]), *own)
    rows = _place(rows).join(aims, F.col("source").eqNullSafe(F.col("__aim")))
    part = (
        F.when(F.col("__place") < F.col("__cut"), F.col("size"))
        .when(F.col("__place") == F.col("__cut"), F.least("size", F.expr("__left div __same")))
        .otherwise(0)
    )
    taken = F.col("__whole") * F.col("size") + F.when(F.col("__rest") > 0, part).otherwise(0)
    return rows.select(*names, "size", "source_size", "target", taken.cast("long").alias("taken"))


def draw(mixed: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The rows of the mix: each document as often as it is taken whole, and its first words where it is taken in part.

    At most one document of each source is cut. A document without words is kept
    once, because it has no part in any budget.
    """
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(1)
    rest = F.when(F.col("size") > 0, F.expr("taken % size")).otherwise(0)
    copies = F.array_repeat(F.lit(-1).cast("long"), whole.cast("int"))
    copies = F.when(rest > 0, F.concat(copies, F.array(rest.cast("long")))).otherwise(copies)
    drawn = mixed.withColumn("__words", F.explode(copies))
    first = F.array_join(F.slice(F.split(F.btrim(or_empty(), F.lit(BLANKS)), r"[\x20\x09-\x0D]+"), 1, F.col("__words").cast("int")), " ")
    return drawn.select(
        *[F.when(F.col("__words") < 0, F.col(c)).otherwise(first).alias(c) if c == "text" else F.col(c) for c in carry]
    )
