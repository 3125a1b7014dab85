"""Text -> dimension id by containment: the first dimension row, in rank order,
whose text is contained in the field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from jornada.functions.clean import right_trim
from jornada.operators.sizes import broadcast_if_small

# A dimension up to this many texts becomes a chain of tests in the row's own
# expression; a larger one is matched by an equi join on short pieces of text.
INLINE_ROWS = 64
# Length of those pieces; shorter texts are pieces as a whole.
GRAM = 3


def normalised(text: Column) -> Column:
    return right_trim(F.lower(text))


def lookup_contains(
    df: DataFrame,
    field: str,
    dim: DataFrame,
    needle: str,
    id_column: str,
    rank: str,
    out: str,
    default: object = None,
    aliases: Sequence[tuple[str, object]] = (),
    inline_rows: int = INLINE_ROWS,
) -> DataFrame:
    """Add ``out``, the id found for ``field``.

    Both sides are compared in lower case without trailing whitespace. Rows of
    the dimension without text or id are skipped, those without rank come last,
    by id. An empty text matches every field, a null field gets the default.
    ``aliases`` (text, id) are tried after the dimension. The result does not
    depend on the size of the dimension.
    """
    kind = dim.schema[id_column].dataType
    order = F.struct(F.col(rank).isNull().alias("_unranked"), F.col(rank).alias("_rank"), F.col(id_column).alias("_id"))
    needles = dim.where(F.col(needle).isNotNull() & F.col(id_column).isNotNull()).select(
        normalised(F.col(needle)).alias("_needle"), order.alias("_first")
    )
    # At most one row more than fits: enough to know which way to go.
    head = needles.limit(inline_rows + 1).collect()
    if len(head) <= inline_rows:
        tests = [(row["_needle"], row["_first"]["_id"]) for row in sorted(head, key=lambda row: row["_first"])]
        prepared = df.withColumn("_field", normalised(F.col(field)))
        found = _first_match("_field", tests, kind)
    else:
        prepared = _join_on_grams(df, field, needles, dim.select(needle, id_column, rank))
        found = F.col("_match")
    alias_found = _first_match("_field", [(a.lower().rstrip(), i) for a, i in aliases], kind)
    result = F.coalesce(found, alias_found, F.lit(default).cast(kind))
    return prepared.withColumn(out, result).drop("_field", "_match")


def _first_match(field: str, tests: Sequence[tuple[str, object]], kind: DataType) -> Column:
    if not tests:
        return F.lit(None).cast(kind)
    return F.coalesce(*[F.when(F.contains(F.col(field), F.lit(n)), F.lit(i).cast(kind)) for n, i in tests])


def _join_on_grams(df: DataFrame, field: str, needles: DataFrame, dim: DataFrame) -> DataFrame:
    """Exact match for a dimension of any size, without comparing all pairs.

    Each text of the dimension is looked for by one of its pieces of GRAM
    characters, the one that fewest texts of the dimension have. Each distinct
    field value is cut once into its pieces, whatever the texts' lengths, and
    each piece carries as much text around it as the longest text of the
    dimension needs; where pieces meet, the whole text is compared in place.
    """
    needles = needles.groupBy("_needle").agg(F.min("_first").alias("_first"))
    size = F.least(F.length("_needle"), F.lit(GRAM)).alias("size")
    # One row: at most GRAM + 1 lengths of pieces, and the longest text.
    found = needles.agg(F.collect_set(size).alias("sizes"), F.max(F.length("_needle")).alias("reach")).first()

    prepared = df.withColumn("_field", normalised(F.col(field)))
    values = prepared.where(F.col("_field").isNotNull()).select("_field").distinct()
    pieces = F.concat(*[_pieces(F.col("_field"), n, found["reach"]) for n in sorted(found["sizes"])] or [F.array()])
    split = values.select(_value_key(F.col("_field")).alias("_value"), F.explode(pieces).alias("_piece"))
    split = split.select("_value", "_piece.*")
    # Texts within Spark's limit are broadcast, and no piece is shuffled. Beyond it
    # they are joined null-safe, so that both sides get an exchange of their own: AQE
    # then sees their real sizes, and can split a piece that occurs in very many
    # fields, or a field value that very many rows share.
    sought = broadcast_if_small(_rarest_piece(needles, dim), dim)
    there = F.substr(F.col("_around"), F.col("_at") - F.col("_offset"), F.length("_needle")) == F.col("_needle")
    matches = (
        split.join(sought, F.col("_gram").eqNullSafe(F.col("_sought")))
        .where((F.col("_at") > F.col("_offset")) & there)
        .groupBy("_value")
        .agg(F.min("_first").alias("_first"))
        .select("_value", F.col("_first._id").alias("_match"))
    )
    same_value = _value_key(F.col("_field")).eqNullSafe(F.col("_value"))
    return prepared.join(matches, same_value, "left").select(*df.columns, "_field", "_match")


def _pieces(text: Column, n: int, reach: int) -> Column:
    """Every piece of n characters, with the text up to ``reach`` before and behind it and the piece's place in that."""

    def piece(at: Column) -> Column:
        start = F.greatest(at - reach, F.lit(1))
        around = F.substr(text, start, at - start + reach)
        return F.struct(F.substr(text, at, F.lit(n)).alias("_gram"), around.alias("_around"), (at - start + 1).alias("_at"))

    if n == 0:
        return F.array(piece(F.lit(1)))
    size = F.length(text)
    starts = F.when(size >= n, F.sequence(F.lit(1), size - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, piece)


def _rarest_piece(needles: DataFrame, dim: DataFrame) -> DataFrame:
    """Each text with the piece of it that fewest texts have, and where that begins in it, from 0."""
    size = F.length("_needle")
    n = F.least(size, F.lit(GRAM))
    pieces = F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.substr(F.col("_needle"), at, n))
    cut = needles.select("_needle", "_first", F.posexplode(pieces).alias("_offset", "_sought"))
    texts = cut.groupBy("_sought").agg(F.count_distinct("_needle").alias("_texts"))
    rarest = F.min(F.struct("_texts", "_offset", "_sought")).alias("_rarest")
    chosen = cut.join(broadcast_if_small(texts, dim), "_sought").groupBy("_needle").agg(rarest, F.min("_first").alias("_first"))
    return chosen.select("_needle", "_first", "_rarest._offset", "_rarest._sought")


def _value_key(text: Column) -> Column:
    """The text itself, or the digest of a long one, so that its pieces stay small rows."""
    return F.when(F.length(text) <= 64, text).otherwise(F.concat(F.lit("#"), F.sha2(text, 256)))
