"""Size checks before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of the optimised plan; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def broadcast_if_small(df: DataFrame, *inputs: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast when all its inputs together are within Spark's limit.

    For tables joined on unique keys, whose result is no larger than the inputs
    together; Spark itself estimates a join by the product of its sides and would
    never broadcast one. Beyond the limit ``df`` is left to a shuffle join.
    """
    if sum(planned_bytes(i) for i in inputs) <= broadcast_limit(df):
        return F.broadcast(df)
    return df
