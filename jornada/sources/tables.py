"""Warehouse and mart tables as parquet folders on shared storage.

A merge writes its rows once, into a folder of its own, ``<table>/_load=<n>``,
and then a small list of the folders that now make up the table,
``<table>/_pointers/<n>``. Readers take the last complete list and never write.
A merge that dies before its list is written has changed nothing and is simply
run again. What the last two lists do not name is removed. A folder that Spark
has written whole, such as one that is only appended to, needs no list.
One load at a time per table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jornada.functions import in_date_range
from jornada.operators.merge import (
    _aligned,
    assert_unique,
    classify_changes,
    delete_by_key,
    key_hash,
    rows_with_known_key,
    rows_with_new_key,
)
from jornada.schemas import table_schema
from jornada.sources.files import children, delete, exists

# Fixed value: how a null partition value is written.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ACTIONS = ("insert", "update", "unchanged", "keep")
STALE = "stale"
LOAD = "_load"

# Key and storage layout of the tables.
TABLE_KEYS = {
    "dim_employee": ("empleado_sesame_id",),
    "dim_department": ("department_sesame_id",),
    "dim_project": ("project_sesame_id",),
    "fact_department_assignment": ("department_assignation_sesame_id",),
    "fact_time_entry": ("time_entry_sesame_id",),
    "fact_worked_hours": ("employee_sesame_id", "date"),
    "fact_time_charge": ("empleado_id", "fecha", "tarea"),
    "fact_signing": ("fecha", "empleado_id"),
    "mart_time_entry": ("imputacion_id",),
    "mart_worked_hours": ("fichaje_diario_id",),
}
SURROGATES = {"dim_employee": "empleado_id", "fact_worked_hours": "worked_hours_id"}
# Partition columns of the tables that grow with time. ``entry_month`` (year *
# 100 + month of the entry's start) exists in storage only.
PARTITIONS = {
    "fact_time_entry": ("entry_month",),
    "fact_worked_hours": ("date",),
    "fact_time_charge": ("fecha",),
    "fact_signing": ("fecha",),
    "mart_time_entry": ("year", "mes"),
    "mart_worked_hours": ("fecha",),
}
# Tables whose key fixes the partition; an edited time entry may change its month.
FIXED_PARTITIONS = ("fact_worked_hours", "mart_worked_hours")


def has_table(spark: SparkSession, path: str) -> bool:
    return bool(_complete_lists(spark, path)) or exists(spark, f"{path}/_SUCCESS")


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The table; where it does not exist yet, an empty one with the declared schema."""
    lists = _complete_lists(spark, path)
    if not lists:
        if not exists(spark, f"{path}/_SUCCESS"):
            return spark.createDataFrame([], table_schema(name))
        return spark.read.parquet(path)
    folders, schema = _listed(spark, path, lists[-1])
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{f}" for f in folders]).select(*schema.names)


def read_days(spark: SparkSession, path: str, column: str, first: date, last: date) -> DataFrame:
    return in_date_range(read_table(spark, path), column, first, last)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a database, with the caller's connection options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    surrogate: str | None = None,
    rows_move: bool = True,
    version: Sequence[str] = (),
) -> dict[str, int]:
    """Create the table from the source, or upsert the source into it.

    Of a partitioned table only the partitions are read and rewritten that the
    source writes to, or that hold the old version of one of its rows. The latter
    are found by a scan of the key columns; with ``rows_move=False`` a key never
    changes its partition, and the scan is saved.

    With ``version`` columns, a row whose version in the table is later than the
    source's stays as it is; see ``classify_changes``.

    Returns the number of rows per action in the rewritten part of the table.
    """
    # The source may be an expensive plan and is used several times: write it once.
    incoming_path = f"{path}.incoming"
    known = has_table(spark, path)
    source.write.mode("overwrite").parquet(incoming_path)
    incoming = spark.read.schema(source.schema).parquet(incoming_path)
    actions = (*ACTIONS, STALE) if version else ACTIONS
    try:
        assert_unique(incoming, keys)
        if incoming.isEmpty():
            return dict.fromkeys(actions, 0)
        if not known:
            if surrogate and surrogate not in incoming.columns:
                incoming = incoming.withColumn(surrogate, key_hash(keys))
            rows, counts = _counted(incoming.withColumn("_action", F.lit("insert")), actions)
            _switch(spark, path, *_write_load(spark, path, rows, partition_by), incoming.schema)
            return counts.get
        target = read_table(spark, path)
        touched = None
        if partition_by and _complete_lists(spark, path):
            homes = _aligned(incoming, target, partition_by)
            if rows_move and not set(partition_by) <= set(keys):
                homes = homes.union(_homes(target, incoming, keys, partition_by))
            touched = _folders_of(homes, partition_by)
            target = target.where(_folder(partition_by).isin(sorted(touched)))
        rows, counts = _counted(classify_changes(target, incoming, keys, surrogate, "_action", version), actions)
        number, folders = _write_load(spark, path, rows, partition_by)
        matched = sum(counts.get[a] for a in actions if a != "keep")
        if matched != incoming.count():
            delete(spark, f"{path}/{LOAD}={number}")
            raise ValueError(f"{path}: key {list(keys)} is not unique in the table")
        if counts.get["insert"] or counts.get["update"]:
            _switch(spark, path, number, folders, target.schema, touched)
        else:
            delete(spark, f"{path}/{LOAD}={number}")
        return counts.get
    finally:
        delete(spark, incoming_path)


def delete_from(
    spark: SparkSession, path: str, gone: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Delete the rows with these keys; only partitions that hold one are rewritten."""
    if not has_table(spark, path):
        return
    target, touched = read_table(spark, path), None
    if partition_by and _complete_lists(spark, path):
        touched = _folders_of(_homes(target, gone, keys, partition_by), partition_by)
        if not touched:
            return
        target = target.where(_folder(partition_by).isin(sorted(touched)))
    number, folders = _write_load(spark, path, delete_by_key(target, gone, keys), partition_by)
    _switch(spark, path, number, folders, target.schema, touched)


def append_new_rows(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    day: str | None = None,
    days: tuple[date, date] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Append the rows of new keys; ``days`` bounds the part of the table searched for known keys."""
    if not has_table(spark, path):
        if not incoming.isEmpty():
            _write(incoming, path, partition_by)
        return
    existing = read_table(spark, path)
    schema = existing.schema
    if day and days:
        existing = in_date_range(existing, day, *days)
    new = rows_with_new_key(incoming, existing, keys, repeated=True)
    if not _complete_lists(spark, path):
        _write(new, path, partition_by, "append")
        return
    number, folders = _write_load(spark, path, _aligned(new, spark.createDataFrame([], schema), schema.names), partition_by)
    _switch(spark, path, number, folders, schema, touched=set())


def _complete_lists(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the lists that were written to their end, ascending."""
    numbers = sorted(int(n) for n in children(spark, f"{path}/_pointers") if n.isdigit())
    return [n for n in numbers if exists(spark, f"{path}/_pointers/{n}/_SUCCESS")]


def _listed(spark: SparkSession, path: str, number: int) -> tuple[list[str], StructType]:
    """The folders of a list, one per partition at most, and the table's schema."""
    lines = spark.read.schema("folder string, schema string").json(f"{path}/_pointers/{number}").collect()
    schema = next(StructType.fromJson(json.loads(x["schema"])) for x in lines if x["schema"])
    return [x["folder"] for x in lines if x["folder"]], schema


def _write_load(spark: SparkSession, path: str, rows: DataFrame, parts: Sequence[str]) -> tuple[int, list[str]]:
    """Write rows into the folder of the next load; returns its number and its folders."""
    lists = _complete_lists(spark, path)
    number = lists[-1] + 1 if lists else 0
    folder = f"{LOAD}={number}"
    _write(rows, f"{path}/{folder}", parts)
    if not parts:
        return number, [folder]
    written = spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
    return number, [f"{folder}/{p}" for p in sorted(_folders_of(written, parts))]


def _switch(
    spark: SparkSession, path: str, number: int, folders: list[str], schema: StructType, touched: set[str] | None = None
) -> None:
    """Make a load visible: from now on the table is made of its folders, and of the old ones of partitions not touched."""
    lists = _complete_lists(spark, path)
    old = _listed(spark, path, lists[-1])[0] if lists else []
    if touched is not None:
        folders = [f for f in old if f.partition("/")[2] not in touched] + folders
    lines = [(None, schema.json()), *[(f, None) for f in folders]]
    frame = spark.createDataFrame(lines, "folder string, schema string")
    frame.coalesce(1).write.mode("overwrite").json(f"{path}/_pointers/{number}")
    # Running readers may still use the version before; older ones go.
    for gone in lists[:-1]:
        for folder in set(_listed(spark, path, gone)[0]) - {*folders, *old}:
            delete(spark, f"{path}/{folder}")
        delete(spark, f"{path}/_pointers/{gone}")


def _folder(parts: Sequence[str]) -> Column:
    """Name of the partition's folder. A filter on it is a filter on partition
    columns only, so other partitions are not even opened."""
    values = [F.coalesce(F.col(p).cast("string"), F.lit(NULL_PARTITION)) for p in parts]
    return F.concat_ws("/", *[F.concat(F.lit(f"{p}="), v) for p, v in zip(parts, values, strict=True)])


def _homes(target: DataFrame, incoming: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Partitions of the rows whose key is among the incoming ones, by a scan of the key columns."""
    located = target.select(*dict.fromkeys([*keys, *parts]))
    return rows_with_known_key(located, incoming.select(*keys), keys).select(*parts)


def _folders_of(homes: DataFrame, parts: Sequence[str]) -> set[str]:
    """One name per partition: no more than the file listing on the driver holds."""
    return {row[0] for row in homes.select(_folder(parts)).distinct().collect()}


def _counted(classified: DataFrame, actions: Sequence[str] = ACTIONS) -> tuple[DataFrame, Observation]:
    """The rows without their action, counting the actions while they are written."""
    counts = Observation()
    metrics = [F.count(F.when(F.col("_action") == a, True)).alias(a) for a in actions]
    return classified.observe(counts, *metrics).drop("_action"), counts


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """Write with few files per partition; a hot partition is split over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).mode(mode).parquet(path)


def load_report(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a merge of the source would do, as row counts per action."""
    merged = classify_changes(read_table(spark, path), source, keys)
    return merged.groupBy("action").agg(F.count("*").alias("rows"))
