"""Document fingerprints by one-permutation MinHash, with Spark's own expressions.

Each shingle (five words, A-Z lower-cased; a shorter text is one shingle) is
hashed once. The top bits of the hash choose a bin, and a bin keeps its least
hash. An empty bin borrows from a full one, chosen by a random order of the
bins that is its own (optimal densification): the first full bin of a few
random probes, else the full bin with the least random rank. The low-order bits of all bins are packed into
64-bit words, and the likeness of two fingerprints is the share of equal bins,
corrected for the bins that agree by chance.

Defined results: a null or empty text, or one of blanks only, has an empty
fingerprint; two empty ones have likeness 1, an empty and another one 0. Equal
texts have equal fingerprints. Rows with the same doc_id follow each other by
the hash of their text; null ids come last. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jornada.llm.words import BLANKS, ascii_lower, or_empty, partitions

SHINGLE = 5
BINS = 256
BITS = 8
PROBES = 6
#: Bits of the hash by which rows of one id are cut into ranges.
PART_BITS = 6


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with its argument evaluated once; a plain column would be evaluated at each use in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, length: int = SHINGLE) -> Column:
    """A 63-bit hash of each shingle."""

    def of(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - length)
        each = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(length)]))
        hashes = F.when(F.size(words) >= length, each).otherwise(F.array(F.xxhash64(words)))
        return F.transform(hashes, lambda h: F.shiftrightunsigned(h, 1))

    return let(F.split(F.btrim(ascii_lower(text), F.lit(BLANKS)), r"[\x20\x09-\x0D]+"), of)


def numbers(values: list[int]) -> Column:
    return F.expr(f"array({','.join(f'{v}L' for v in values)})")


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> Column:
    """Packed low-order bits as an array of longs; null for a text without words."""
    width = bins.bit_length() - 1
    if bins != 1 << width or 64 % bits or bits < 1 or bins * bits % 64:
        raise ValueError("the bins must be a power of two and the bits a divisor of 64, and they must fill whole words")
    shift, rest = 63 - width, (1 << (63 - width)) - 1
    # A mark for each bin, greater than its hashes: after sorting, the first value of each bin is its least or its mark.
    marks = numbers([(b << shift) | rest for b in range(bins)])

    def least(values: Column) -> Column:
        return F.filter(
            values,
            lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(values, i - 1), shift)),
        )

    def full(x: Column) -> Column:
        return x.bitwiseAND(F.lit(rest)) != rest

    def densified(first: Column) -> Column:
        def with_full(own: Column) -> Column:
            def filled(x: Column, i: Column) -> Column:
                def probe(t: int) -> Column:
                    return let(
                        F.get(first, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(bins)).cast("int")),
                        lambda y: F.when(full(y), y),
                    )

                ranked = F.transform(
                    own, lambda y: F.struct(F.xxhash64(i, F.shiftright(y, shift)).alias("rank"), y.alias("value"))
                )
                return F.when(full(x), x).otherwise(
                    F.coalesce(*[probe(t) for t in range(PROBES)], F.array_min(ranked)["value"])
                )

            return F.transform(first, filled)

        return let(F.filter(first, full), with_full)

    per_word = 64 // bits

    def packed(values: Column) -> Column:
        def word(j: Column) -> Column:
            out = None
            for k in range(per_word):
                low = F.get(values, j * per_word + k).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
                low = F.shiftleft(low, bits * (per_word - 1 - k))
                out = low if out is None else out.bitwiseOR(low)
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(bins // per_word - 1)), word)

    hashes = F.sort_array(F.concat(shingle_hashes(text, shingle), marks))
    value = let(let(let(hashes, least), densified), packed)
    return F.when(F.length(F.btrim(text, F.lit(BLANKS))) > 0, value)


def as_text(packed: Column) -> Column:
    """The packed words in hexadecimal; an empty text for an empty fingerprint."""
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimate of the Jaccard similarity, from 0 to 1, corrected for bins that agree by chance."""
    low = int("".join("0" * (bits - 1) + "1" for _ in range(64 // bits)), 2)
    low -= (low >> 63) << 64

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        shift = bits // 2
        while shift:
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
            shift //= 2
        return F.bit_count(z.bitwiseAND(F.lit(low)))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda total, x: total + x)
    chance = 2.0**-bits
    share = (1 - differing / bins - chance) / (1 - chance)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), share))


def with_next(docs: DataFrame, columns: list[str], ranges: int | None = None) -> DataFrame:
    """Each row with the given columns of the next one, in descending order of doc_id, as next_<name>; the first follows the last.

    Rows without id come last, and rows of one id follow each other by a hash of
    the text. The ids are cut into ranges at quantiles, a few per shuffle
    partition; an id of more rows than a range should have, and rows without id,
    are cut by that hash as well. Each row moves once, to its range; the first row of a range is also sent to the
    range before, where it ends the order. Only the bounds and first ids of the
    ranges pass through the driver, a number set by the partitions.
    """
    spark = docs.sparkSession
    ranges = ranges or 8 * partitions(spark)
    levels = F.expr(f"array({','.join(repr((i + 1) / ranges) for i in range(ranges - 1))})") if ranges > 1 else None
    found = []
    if levels is not None:
        found = docs.agg(F.percentile_approx("doc_id", levels, 10 * max(1000, ranges))).first()[0] or []
    bounds = sorted(set(found))
    many = sorted({a for a, b in zip(found, found[1:]) if a == b})
    step = max(1, int(len(bounds) ** 0.5))

    def by_id(doc_id: Column) -> Column:
        if not bounds:
            return F.when(doc_id.isNull(), -1).otherwise(0)
        parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
        lists = F.expr(f"array({','.join('array(' + ','.join(f'{b}L' for b in part) + ')' for part in parts)})")
        ends = numbers([part[-1] for part in parts])

        def within(part: Column) -> Column:
            inner = F.size(F.filter(F.get(lists, part), lambda b: b < doc_id))
            return part * step + F.when(part < len(parts), inner).otherwise(0)

        return F.when(doc_id.isNull(), -1).otherwise(let(F.size(F.filter(ends, lambda b: b < doc_id)), within))

    def range_of(doc_id: Column, hashed: Column) -> Column:
        """Ranges in ascending order of id; within a cut id, in descending order of the hash."""
        part = F.shiftright(hashed, 64 - PART_BITS).cast("int") + (1 << (PART_BITS - 1))
        cut = doc_id.isNull() | (doc_id.isin(many) if many else F.lit(False))
        return by_id(doc_id) * ((1 << PART_BITS) + 1) + F.when(cut, (1 << PART_BITS) - part).otherwise(0)

    ranged = docs.withColumn("_hash", F.xxhash64(or_empty()))
    ranged = ranged.withColumn("_range", range_of(F.col("doc_id"), F.col("_hash")))
    first = F.max(F.struct("doc_id", F.bitwise_not("_hash").alias("not_hash"))).alias("first")
    heads = ranged.select("doc_id", "_hash", "_range").groupBy("_range").agg(first).select("_range", "first.*").collect()
    heads.sort(key=lambda r: -r["_range"])
    sent = [(head["doc_id"], ~head["not_hash"], heads[i - 1]["_range"]) for i, head in enumerate(heads)]
    goes = spark.createDataFrame(sent, "_id long, _text long, _before int")
    both = ranged.join(F.broadcast(goes), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text")), "left")
    here = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_before").alias("range"), F.lit(True).alias("guest"))
    places = F.when(F.col("_before").isNull(), F.array(here)).otherwise(F.array(here, guest))
    both = both.withColumn("_place", F.explode(places)).withColumn("_at", F.col("_place.range"))
    order = Window.partitionBy("_at").orderBy(F.col("_place.guest"), F.col("doc_id").desc_nulls_last(), "_hash")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    out = both.select(*docs.columns, "_place", *following)
    return out.filter(~F.col("_place.guest")).drop("_place")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many code points of the next one, or all that it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint_documents(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of the texts, of the next documents and of the edited texts, and their likeness.

    Own fingerprints are made before the one shuffle, those of edited texts after it.
    """
    own = docs.select(F.col("doc_id").cast("long"), or_empty().alias("text"))
    own = own.withColumn("print", fingerprint(F.col("text"), bins, bits))
    pairs = with_next(own, ["text", "print"])
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    pairs = pairs.withColumn("edited_print", fingerprint(F.col("edited"), bins, bits))
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        "print",
        "edited_print",
        likeness(F.col("print"), F.col("edited_print"), bins, bits).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print"), bins, bits).alias("near_next"),
    )
