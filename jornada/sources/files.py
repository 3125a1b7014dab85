"""File checks through the file system that holds the path (HDFS, object store, local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on_file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _on_file_system(spark, path)
    return file_system.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _on_file_system(spark, path)
    return file_system.exists(hadoop_path) and file_system.getFileStatus(hadoop_path).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _on_file_system(spark, path)
    file_system.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no such folder."""
    file_system, hadoop_path = _on_file_system(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]
