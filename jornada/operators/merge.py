"""Change classification, upsert, append-new and delete on DataFrames.

Keys are matched null-safe: a null key equals a null key, as in an index lookup.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _aligned(df: DataFrame, like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, cast to the types they have in ``like``."""
    return df.select(*[F.col(c).cast(like.schema[c].dataType).alias(c) for c in columns])


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[f"_key_{k}"]) for k in keys])


def _key_set(df: DataFrame, like: DataFrame, keys: Sequence[str], repeated: bool) -> DataFrame:
    """Keys under other names; repeated keys are made distinct before the join,
    so that a hot key of a fact is one row there."""
    chosen = _aligned(df, like, keys)
    if repeated:
        chosen = chosen.distinct()
    return chosen.withColumnsRenamed({k: f"_key_{k}" for k in keys})


def rows_with_known_key(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str], repeated: bool = False
) -> DataFrame:
    """Incoming rows whose key exists; ``repeated`` says existing keys are not unique."""
    known = _key_set(existing, incoming, keys, repeated)
    return incoming.join(known, _same_key(incoming, known, keys), "left_semi")


def rows_with_new_key(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str], repeated: bool = False
) -> DataFrame:
    """Incoming rows whose key does not exist yet."""
    known = _key_set(existing, incoming, keys, repeated)
    return incoming.join(known, _same_key(incoming, known, keys), "left_anti")


def append_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows plus incoming rows of new keys; incoming duplicates all stay."""
    new_rows = rows_with_new_key(incoming, existing, keys, repeated=True)
    return existing.unionByName(new_rows, allowMissingColumns=True)


def delete_by_key(target: DataFrame, keys_to_delete: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows_with_new_key(target, keys_to_delete, keys, repeated=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Run a key count and fail on a repeated key; see ``latest_per_key``."""
    repeated = duplicate_keys(df, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"key {list(keys)} is not unique, for example {repeated[0].asDict()}")


def classify_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    surrogate: str | None = None,
    action: str = "action",
    version: Sequence[str] = (),
) -> DataFrame:
    """The merged table with an action per row.

    insert: new key; update: some shared column differs (null-safe), source
    values win, nulls included; unchanged: no difference; keep: key absent from
    the source. Columns that only the target has keep their value; for an
    insert they are null, except the surrogate, which is a hash of the key.
    Keys must be unique on both sides. One full outer join, one shuffle a side.

    With ``version`` columns, such as an update time and a tie-break, which both
    sides have, the later version of a row wins, whatever the order in which
    loads run: a row whose version in the target is later is stale and keeps its
    values. Versions are compared column by column, and null is the earliest.
    """
    unknown = set(source.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"columns not in the target: {sorted(unknown)}")
    absent = [c for c in version if c not in source.columns or c not in target.columns]
    if absent:
        raise ValueError(f"no column for the version: {absent}")
    values = [c for c in source.columns if c not in keys]
    new = _aligned(source, target, source.columns).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in values],
        F.lit(True).alias("_in_source"),
    )
    old = target.withColumn("_in_target", F.lit(True))
    joined = old.join(new, _same_key(old, new, keys), "full_outer")

    in_source, in_target = F.col("_in_source").isNotNull(), F.col("_in_target").isNotNull()
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in values], F.lit(False))
    taken, label = in_source, F.when(~in_target, "insert").when(~in_source, "keep")
    if version:
        held, given = [F.struct(*[F.col(p + c) for c in version if c not in keys]) for p in ("", "_new_")]
        stale = in_target & in_source & (held > given)
        taken, label = in_source & ~stale, label.when(stale, "stale")
    label = (
        label.when(differs, "update")
        .otherwise("unchanged")
        .alias(action)
    )

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(name, f"_key_{name}").alias(name)
        if name in values:
            return F.when(taken, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        if name == surrogate:
            return F.when(in_target, F.col(name)).otherwise(key_hash([f"_key_{k}" for k in keys])).alias(name)
        return F.col(name)

    return joined.select(*[merged(c) for c in target.columns], label)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    surrogate: str | None = None,
    version: Sequence[str] = (),
) -> DataFrame:
    return classify_changes(target, source, keys, surrogate, "_action", version).drop("_action")


def count_actions(classified: DataFrame, action: str = "action") -> DataFrame:
    return classified.groupBy(action).agg(F.count("*").alias("rows"))


def key_hash(keys: Sequence[str]) -> Column:
    """Surrogate id of a natural key: the same key always gets the same id."""
    return F.xxhash64(*keys)
