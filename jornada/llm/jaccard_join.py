"""Exact Jaccard join of word shingles in metric space.

A document is a point: the set of its distinct shingles (five words, A-Z
lower-cased; fewer words are one shingle). Two documents link when the Jaccard
distance of their sets is at most 0.2.

Regions come in two kinds, and both are joined exactly.

* Pivots of the first regions are the shingles themselves, sets of one element.
  A document's nearest pivot, with ties broken by one order of all shingles
  (frequent ones last), is its first shingle. Leaving out its first i shingles
  is the least change that carries a document to the cell of shingle i + 1, at
  distance i / size; so a document is replicated into the cells whose distance
  is within the window, which are those of its first fifth of shingles. Linked
  documents meet in the cell of their first common shingle. Documents as first
  pivots cannot part a corpus: nearly all documents are at distance 1 from each
  other, so all of them would fall into every window.
* A cell of many documents is split by pivots chosen among them, in the metric
  that counts differing bits of the sets' bitmaps (parities of hashed shingles,
  folded to one size). It never exceeds the number of shingles that differ, so a
  link bounds it, and the triangle inequality gives the windows. Every member
  goes to the region of its nearest pivot and is replicated to each pivot within
  its window. Pairs with a pivot that may link are checked first: members linked
  to one are a component, so a group of near copies is joined by its pivots.
  Regions that still hold several components are split again while they are
  large, and small ones are joined pair by pair, across components only and
  within the window around the pivot. Where pivots do not part regions any more,
  the members are cut into blocks, and each pair of blocks is joined by itself.

Pairs are first held against the bitmaps, which lose no link, and the rest
against the sets.

Defined results: a null text is an empty one; documents without words have no
shingles and are alone. Documents with the same set are one class, which is
linked by nature. Rows with the same doc_id count as one document that has the
links of all its texts. A null doc_id is linked like any other, but is never
the smallest; a component of nulls alone has a null id. Empty tables give no
rows. Other columns are ignored.

Shingles are told apart by 64-bit hashes and sets by 128-bit digests.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jornada.llm.components import components
from jornada.llm.shingles import sets_of
from jornada.llm.words import partitions, stored

#: Similarity from which documents link, as a fraction: 4/5.
ABOVE, BELOW = 4, 5
#: Cells of more documents are joined around pivots, smaller ones pair by pair; regions of more documents are split again.
SMALL, IN_TASK = 16, 4000
#: Tasks that the members of a frequent shingle's cell are dealt to.
SALTS = 64
PIVOTS = 4
#: The side of members that are joined with all of their region; others are joined with the other side.
BOTH = 2
#: Bits that all bitmaps have at least, and that the metric is taken on.
FOLDED = 2048
#: Shingles known to be frequent; they only come last in the order, so the bound costs no result.
FREQUENT, MOST_FREQUENT, LOCAL = 50, 100_000, 8
COUNTED_AT_ONCE = 1 << 21
_NULL = 1 << 62

DESCRIBED = "id long, n int, node long, digest binary, bits binary, shingle long, times long"


def bitmap(found: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each of about as many bits as the set has elements."""
    size = max(FOLDED, 1 << (len(found) - 1).bit_length()) if len(found) else FOLDED
    odd = np.bincount((found % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """At least so many shingles are in only one of two sets, by their bitmaps; the longer one is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def described(docs: DataFrame) -> DataFrame:
    """A row per document (id, size, node, digest, bitmap), and rows (shingle, times) of shingles frequent in a task.

    `node` is a part of the digest; sets with the same node by chance are
    told apart by their digests in the end.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()
        total = 0

        def frequent() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            many = times >= LOCAL
            n = int(many.sum())
            columns = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())]
            columns += [pa.array(values[many].view(np.int64)), pa.array(times[many], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        names = ["id", "n", "node", "digest", "bits", "shingle", "times"]
        for given in batches:
            rows = []
            for doc_id, found in zip(given.column(0).to_pylist(), sets_of(given.column(1))):
                digest = xxhash.xxh3_128_digest(found.tobytes())
                node = int.from_bytes(digest[:8], "little", signed=True)
                if doc_id is None:
                    doc_id = _NULL + (node & (_NULL - 1))
                rows.append((doc_id, len(found), node, digest, bitmap(found)))
                if digest not in seen and len(found):
                    if len(seen) < 100_000:
                        seen.add(digest)
                    held.append(found)
                    total += len(found)
                    if total > COUNTED_AT_ONCE:
                        yield frequent()
                        held, total = [], 0
            kinds = pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
            columns += [pa.nulls(len(rows), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if held:
            yield frequent()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, DESCRIBED)


def frequent_shingles(rows: DataFrame) -> np.ndarray:
    """The most frequent shingles, rarest first; only they come to the driver, at most MOST_FREQUENT numbers."""
    found = rows.filter(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("times").alias("times"))
    found = found.filter(F.col("times") >= FREQUENT).orderBy(F.col("times").desc(), "shingle").limit(MOST_FREQUENT)
    return np.array([r["shingle"] for r in found.collect()][::-1], np.int64).view(np.uint64)


def cells(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Rows (region, node, n, rank, frequent) of the cells that each set reaches; copies within a task are left out."""
    by_value = np.argsort(frequent)
    known = frequent[by_value]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for given in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            held = 0

            def batch() -> pa.RecordBatch:
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                return pa.RecordBatch.from_arrays(columns, names=["region", "node", "n", "rank", "frequent"])

            for found in sets_of(given.column(0)):
                n = len(found)
                if not n:
                    continue
                node = int.from_bytes(xxhash.xxh3_128_digest(found.tobytes())[:8], "little", signed=True)
                if node in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                rare = n
                if len(known):
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    common = known[at] == found
                    if common.any():
                        last = np.sort(by_value[at[common]])
                        found = np.concatenate([found[~common], frequent[last]])
                        rare -= len(last)
                reach = n * (BELOW - ABOVE) // BELOW + 1
                parts.append(
                    (
                        found[:reach].view(np.int64),
                        np.full(reach, node, np.int64),
                        np.full(reach, n, np.int32),
                        np.arange(reach, dtype=np.int32),
                        np.arange(reach) >= rare,
                    )
                )
                held += reach
                if held > 200_000:
                    yield batch()
                    parts, held = [], 0
            if parts:
                yield batch()

    return docs.select("text").mapInArrow(work, "region long, node long, n int, rank int, frequent boolean")


def _may_meet(n_a, n_b, rank_a, rank_b):
    """Whether two members of a cell may link: by their sizes, and by what can still be common after this shingle."""
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    rest = np.minimum(n_a - rank_a, n_b - rank_b)
    fits = (BELOW * low >= ABOVE * high) & ((BELOW + ABOVE) * rest >= ABOVE * (n_a + n_b))
    # Linked sets meet within the first ninth of the smaller one.
    reach = low * (BELOW - ABOVE) // (BELOW + ABOVE) + 1
    return fits & (np.where(n_a == n_b, np.minimum(rank_a, rank_b), np.where(n_a < n_b, rank_a, rank_b)) < reach)


def split(members: DataFrame, small: int = SMALL) -> DataFrame:
    """Of small cells the pairs (a, b) that may link, of larger ones the members (node a, with region, n, rank).

    Rows come sorted by cell, and a task holds a batch of them and one small
    cell at a time.
    """
    names = ["region", "node", "n", "rank", "frequent"]
    out = ["a", "b", "region", "n", "rank"]

    def batch(a, b=None, region=None, n=None, rank=None) -> pa.RecordBatch:
        columns = [
            pa.nulls(len(a), kind) if c is None else pa.array(c, kind)
            for c, kind in zip((a, b, region, n, rank), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))
        ]
        return pa.RecordBatch.from_arrays(columns, names=out)

    def joined(rows: list[np.ndarray], large_one: int | None) -> Iterator[pa.RecordBatch]:
        region, node, n, rank, frequent = rows
        first = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        lengths = np.diff(np.append(first, len(region)))
        many = (lengths > small) | frequent[first]
        if large_one is not None:
            many |= region[first] == large_one
        large = np.repeat(many, lengths)
        if large.any():
            yield batch(node[large], None, region[large], n[large], rank[large])
        left, right = [], []
        rest = lengths[~many]
        n, rank = n.astype(np.int64), rank.astype(np.int64)
        for k in range(1, int(rest.max()) if len(rest) else 0):
            i = np.flatnonzero((region[k:] == region[:-k]) & ~large[k:])
            i = i[(node[i] != node[i + k]) & _may_meet(n[i], n[i + k], rank[i], rank[i + k])]
            left.append(np.minimum(node[i], node[i + k]))
            right.append(np.maximum(node[i], node[i + k]))
        if left:
            pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
            if len(pairs):
                yield batch(np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] | None = None
        large_one: int | None = None
        for given in batches:
            rows = [given.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
            if waiting is not None:
                rows = [np.concatenate(x) for x in zip(waiting, rows)]
            region = rows[0]
            if not len(region):
                continue
            last = int(np.searchsorted(region, region[-1]))
            if len(region) - last > small or region[-1] == large_one:
                # The last cell is large already: what is there can go, and so will the rest of it.
                yield from joined(rows, large_one)
                waiting, large_one = None, int(region[-1])
            else:
                if last:
                    yield from joined([x[:last] for x in rows], large_one)
                waiting = [x[last:] for x in rows]
        if waiting is not None:
            yield from joined(waiting, large_one)

    # Cells of frequent shingles are large, so their members need not meet here: they are dealt out, and no task gets them all.
    salt = F.when(F.col("frequent"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0)
    dealt = members.repartition(partitions(members.sparkSession), "region", salt).sortWithinPartitions("region")
    return dealt.select(*names).mapInArrow(work, "a long, b long, region long, n int, rank int")


def may_link(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps leave room for a link."""
    told = classes.select("node", "n", "bits")
    for side in "ab":
        other = told.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(other.hint("merge"), side)

    @F.pandas_udf("int")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([differing(x, y) for x, y in zip(a, b)], dtype="int32")

    pairs = pairs.withColumn("_apart", apart("bits_a", "bits_b"))
    # With an overlap of at least 4/9 of both sizes together, at most 1/9 of them differs.
    both = (F.col("n_a") + F.col("n_b")).cast("long")
    return pairs.filter(F.col("_apart") * (BELOW + ABOVE) <= both * (BELOW - ABOVE)).select("a", "b").distinct()


def measured(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges (a, b) with the ids of their documents, their distance, and whether they link."""
    for side in "ab":
        other = sets.select(F.col("node").alias(side), F.col("id").alias(f"id_{side}"), F.col("hashes").alias(f"set_{side}"))
        edges = edges.join(other.hint("merge"), side)

    @F.pandas_udf("long")
    def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
        found = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(a, b)
        ]
        return pd.Series(found, dtype="int64")

    both = (F.length("set_a") / 8 + F.length("set_b") / 8).cast("long")
    edges = edges.select("a", "b", "id_a", "id_b", overlap("set_a", "set_b").alias("_common"), both.alias("_both"))
    union = F.col("_both") - F.col("_common")
    return edges.select(
        "a", "b", "id_a", "id_b", (1 - F.col("_common") / union).alias("d"), (F.col("_common") * BELOW >= union * ABOVE).alias("links")
    )


def sets_for(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, node and sorted hashes of the documents that stand for these nodes' classes; only their sets are kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            rows = []
            for doc_id, found in zip(given.column(0).to_pylist(), sets_of(given.column(1))):
                raw = found.tobytes()
                node = int.from_bytes(xxhash.xxh3_128_digest(raw)[:8], "little", signed=True)
                rows.append((_NULL + (node & (_NULL - 1)) if doc_id is None else doc_id, node, raw))
            kinds = pa.int64(), pa.int64(), pa.binary()
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 3, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "hashes"])

    wanted = classes.join(nodes.hint("merge"), "node", "left_semi")
    asked = wanted.select(F.when(F.col("id") < _NULL, F.col("id")).alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    texts = texts.join(asked.hint("merge"), texts["doc_id"].eqNullSafe(asked["doc_id"]), "left_semi")
    found = texts.mapInArrow(work, "id long, node long, hashes binary")
    found = found.join(wanted.select("id", "node").hint("merge"), ["id", "node"], "left_semi")
    return found.dropDuplicates(["id", "node"])


def _folded(bits: bytes) -> np.ndarray:
    x = np.frombuffer(bits, np.uint8)
    while len(x) > FOLDED // 8:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def around_pivots(members: DataFrame, bits: DataFrame) -> DataFrame:
    """Each member (region, node, n, rank) with each pivot of its region and their distance d in differing bits.

    Pivots are the first by hash, so that cells of the same group choose the
    same ones. Members meet the few pivots of their region in a join whose hot
    partitions Spark can split.
    """
    first = Window.partitionBy("region").orderBy(F.xxhash64("node"), "node")
    pivots = members.select("region", "node").distinct().withColumn("__n", F.row_number().over(first))
    pivots = stored(pivots.filter(F.col("__n") <= PIVOTS).select("region", F.col("node").alias("pivot")))
    met = stored(members.join(pivots.hint("merge"), "region").select("region", "pivot", "node", "n", "rank"))

    @F.pandas_udf("int")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([int(np.bitwise_count(_folded(x) ^ _folded(y)).sum()) for x, y in zip(a, b)], dtype="int32")

    # Cells of one group have the same members and pivots: each distance is taken once.
    edges = met.select("pivot", "node").distinct()
    edges = edges.join(bits.hint("merge"), "node").withColumnRenamed("bits", "__own")
    edges = edges.join(bits.withColumnRenamed("node", "pivot").hint("merge"), "pivot")
    edges = stored(edges.select("pivot", "node", apart("__own", "bits").alias("d")))
    return met.join(edges.hint("merge"), ["pivot", "node"])


def voronoi(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the regions around each pivot: those nearest to it, and those within the window.

    A linked pair differs in at most a ninth of both sizes, which is at most a
    quarter of either one's size. Only regions of several components stay.
    """
    of_member = Window.partitionBy("region", "node")
    rows = met.withColumn("_least", F.min("d").over(of_member))
    rows = rows.withColumn("_nearest", F.min(F.when(F.col("d") == F.col("_least"), F.col("pivot"))).over(of_member))
    rows = rows.filter(F.col("d") * 2 <= F.col("_least") * 2 + F.col("n"))
    rows = rows.join(labels.select("node", "label").hint("merge"), "node", "left")
    regions = rows.select(
        F.xxhash64("region", "pivot").alias("region"),
        "node",
        "n",
        "rank",
        F.coalesce("label", "node").alias("label"),
        "d",
        (F.col("_nearest") == F.col("pivot")).alias("home"),
    )
    return several(regions)


def whole(met: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of each region with their distance to one of its pivots. Only regions of several components stay."""
    rows = met.groupBy("region", "node", "n", "rank").agg(F.min(F.struct("pivot", "d"))["d"].alias("d"))
    rows = rows.join(labels.select("node", "label").hint("merge"), "node", "left")
    return several(rows.withColumns({"label": F.coalesce("label", "node"), "home": F.lit(True)}))


def several(regions: DataFrame) -> DataFrame:
    """The members of regions that hold several components, with the region's size."""
    sizes = regions.groupBy("region").agg(F.min("label").alias("__low"), F.max("label").alias("__high"), F.count("*").alias("size"))
    sizes = stored(sizes.filter(F.col("__low") < F.col("__high")).select("region", "size"))
    return regions.join(sizes.hint("merge"), "region")


def in_blocks(regions: DataFrame) -> DataFrame:
    """The members of regions dealt to regions of two blocks each, which hold at most about two thirds of IN_TASK.

    Blocks are cut by hash within bands of sizes. Linked sets lie in the same
    band or the next. One of the two, the smaller, has its shingle in the first
    ninth, so late members only meet early ones that are no larger, and those
    without such a partner are left out. `side` is the block's, or BOTH where a
    block meets itself.
    """
    # A little wider than sizes of linked sets lie apart, so that rounding loses nothing.
    band = F.floor(F.log("n") / math.log(1.01 * BELOW / ABOVE)).cast("int")
    late = F.col("rank") > F.floor(F.col("n") * (BELOW - ABOVE) / (BELOW + ABOVE))
    rows = regions.withColumns({"band": band, "late": late})
    groups = rows.groupBy("region", "band", "late").agg(F.count("*").alias("members"))
    groups = groups.select("region", "band", "late", F.ceil(F.col("members") * 3 / IN_TASK).cast("int").alias("blocks"))
    # A few groups for each region.
    groups = stored(groups)
    early = groups.filter(~F.col("late")).select("region", F.col("band").alias("low"), F.col("blocks").alias("low_blocks"))
    met = early.join(groups.hint("merge"), "region")
    met = stored(met.filter((F.col("band") == F.col("low")) | (F.col("band") == F.col("low") + 1)))
    itself = (F.col("low") == F.col("band")) & ~F.col("late")
    pair = F.xxhash64("low", "band", "late").alias("pair")
    here = ("region", "band", "late", "blocks")
    parts = [
        met.filter(itself).select(*here, F.lit(BOTH).alias("role"), F.col("blocks").alias("others"), pair),
        met.filter(~itself).select(*here, F.lit(1).alias("role"), F.col("low_blocks").alias("others"), pair),
        met.filter(~itself).select(
            "region", F.col("low").alias("band"), F.lit(False).alias("late"), F.col("low_blocks").alias("blocks"),
            F.lit(0).alias("role"), F.col("blocks").alias("others"), pair,
        ),
    ]
    rows = rows.join(stored(functools.reduce(DataFrame.union, parts)).hint("merge"), ["region", "band", "late"])
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    first = F.when(F.col("role") == BOTH, F.least("slot", "other")).when(F.col("role") == 0, F.col("slot")).otherwise(F.col("other"))
    second = F.when(F.col("role") == BOTH, F.greatest("slot", "other")).when(F.col("role") == 0, F.col("other")).otherwise(F.col("slot"))
    side = F.when((F.col("role") != BOTH) | (F.col("slot") == F.col("other")), F.col("role")).otherwise((F.col("slot") > F.col("other")).cast("int"))
    unit = F.xxhash64("region", "pair", first, second).alias("region")
    return rows.select(unit, "node", "n", "rank", "label", "d", "home", side.alias("side"))


def pairs_within(regions: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs of each region that may link, across components and within the window, by their bitmaps."""
    names = ["region", "node", "n", "rank", "label", "d", "home", "side", "bits"]

    def joined(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, node, n, rank, label, d, home, side, bits = rows
        n, rank, d = n.astype(np.int64), rank.astype(np.int64), d.astype(np.int64)
        folded = np.stack([_folded(x) for x in bits])
        for i in range(len(node) - 1):
            j = np.arange(i + 1, len(node))
            fits = (label[j] != label[i]) & (node[j] != node[i]) & (home[j] | home[i])
            fits &= (side[j] != side[i]) | (side[j] == BOTH)
            fits &= ((BELOW + ABOVE) * np.abs(d[j] - d[i]) <= n[j] + n[i]) & _may_meet(n[i], n[j], rank[i], rank[j])
            j = j[fits]
            if not len(j):
                continue
            differ = np.bitwise_count(folded[j] ^ folded[i]).sum(1, dtype=np.int64)
            j = j[(BELOW + ABOVE) * differ <= n[j] + n[i]]
            if len(j):
                a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] | None = None
        for given in batches:
            rows = [given.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
            if waiting is not None:
                rows = [np.concatenate(x) for x in zip(waiting, rows)]
            ends = np.flatnonzero(rows[0][1:] != rows[0][:-1]) + 1
            start = 0
            for end in ends:
                yield from joined([x[start:end] for x in rows])
                start = end
            waiting = [x[start:] for x in rows]
        if waiting is not None and len(waiting[0]):
            yield from joined(waiting)

    if "side" not in regions.columns:
        regions = regions.withColumn("side", F.lit(BOTH))
    known = regions.join(bits.hint("merge"), "node").select(*names)
    dealt = known.repartition(partitions(regions.sparkSession), "region").sortWithinPartitions("region")
    return dealt.mapInArrow(work, "a long, b long").distinct()


def links(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the documents that stand for classes: enough of them to connect all that are linked."""
    found = stored(split(cells(docs, frequent_shingles(rows))))
    close = may_link(found.filter(F.col("region").isNull()).select("a", "b").distinct(), classes)
    members = found.filter(F.col("region").isNotNull())
    members = members.select(F.col("a").alias("node"), "region", "n", "rank").distinct()
    bits = classes.select("node", "bits")
    met, linked, before = None, None, None
    left = not members.isEmpty()
    while True:
        if left:
            # Sets of members are kept only where their bitmaps leave room for a link with a pivot.
            met = stored(around_pivots(members, bits))
            close = close.union(may_link(with_pivot(met), classes)).distinct()
        close = stored(close)
        told = measured(close, stored(sets_for(docs, classes, nodes_of(close))))
        told = told.filter("links").select("a", "b", "id_a", "id_b")
        linked = stored(told if linked is None else linked.union(told))
        if not left:
            return linked.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
        labels = components(linked)
        regions = stored(whole(met, labels))
        size = regions.agg(F.max("size")).first()[0] or 0
        stuck = before is not None and size >= before * 3 / 4
        left, before = size > IN_TASK, size
        close = pairs_within(regions.filter(F.col("size") <= IN_TASK), bits)
        if left and stuck:
            # Pivots do not part regions any more.
            close = close.union(pairs_within(in_blocks(regions.filter(F.col("size") > IN_TASK)), bits)).distinct()
            left = False
        elif left:
            large = regions.filter(F.col("size") > IN_TASK).select("region").distinct()
            parts = stored(voronoi(met.join(large.hint("merge"), "region"), labels))
            close = close.union(pairs_within(parts.filter(F.col("size") <= IN_TASK), bits)).distinct()
            members = parts.filter(F.col("size") > IN_TASK).select("node", "region", "n", "rank")
            left = not members.isEmpty()
        close = may_link(close, classes)


def nodes_of(*pairs: DataFrame) -> DataFrame:
    both = [p.select(F.explode(F.array("a", "b")).alias("node")) for p in pairs]
    return functools.reduce(DataFrame.union, both).distinct()


def with_pivot(met: DataFrame) -> DataFrame:
    """The pairs of members and pivots whose distance leaves room for a link."""
    close = met.filter((F.col("node") != F.col("pivot")) & (F.col("d") * 4 <= F.col("n")))
    return close.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = stored(described(docs))
    texts = rows.filter(F.col("digest").isNotNull())
    classes = texts.filter(F.col("n") > 0).groupBy("digest", "node", "n").agg(F.min("id").alias("id"), F.first("bits").alias("bits"))
    classes = stored(classes)
    found = links(docs, rows, classes)
    # A document of several texts joins their classes; one without words has no class, but may be such a text.
    several = texts.filter(F.col("id") < _NULL).groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = stored(several.filter(F.col("low") < F.col("high")).select("id"))
    held = texts.join(several.hint("merge"), "id", "left_semi").select(F.col("id").alias("b"), "digest")
    through = held.join(classes.select("digest", F.col("id").alias("a")).hint("merge"), "digest").select("a", "b")
    labels = components(found.union(through))
    named = classes.select("digest", "id").join(labels.hint("merge"), F.col("id") == F.col("node"), "left")
    named = stored(named.select("digest", F.coalesce("label", "id").alias("_component")))
    own = several.join(labels.hint("merge"), F.col("id") == F.col("node")).select("id", F.col("label").alias("_own"))
    out = texts.select("id", F.col("n").cast("long").alias("n_shingles"), "digest").join(named.hint("merge"), "digest", "left")
    out = out.join(stored(own).hint("merge"), "id", "left")
    component = F.coalesce("_component", "_own", "id")
    return out.select(
        F.when(F.col("id") < _NULL, F.col("id")).alias("doc_id"),
        "n_shingles",
        F.when(component < _NULL, component).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with all columns, that have the smallest doc_id of their component.

    Of rows with the same doc_id the first by a hash of the text stays. Rows
    without doc_id stay, because nothing tells which of them they are.
    """
    kept = near_duplicates(docs).filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rows = docs.withColumn("__id", F.col("doc_id").cast("long"))
    rows = rows.join(kept.withColumnRenamed("doc_id", "__id").hint("merge"), "__id", "left_semi")
    first = Window.partitionBy("__id").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") == 1)
    return rows.select(*docs.columns).unionAll(docs.filter(F.col("doc_id").isNull()))
