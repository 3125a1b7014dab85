"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a cluster job should start with. AQE picks broadcast joins from
# measured sizes, coalesces small shuffle partitions and splits skewed ones.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the call site of every column expression doubles the time to build a wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "jornada", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All dates in the library are UTC dates, whatever the session started with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else one below the warehouse folder.

    On a cluster a warehouse folder of one machine does not do, as executors
    would each write to their own disk: there a folder has to be named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} is one machine's own")
    return warehouse.rstrip("/") + "/_checkpoints"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder, which is also set as the place of the session's checkpoints."""
    named = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named
