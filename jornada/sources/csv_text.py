"""CSV with a header row and a declared schema, as files or as a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Values keep their outer blanks; a quote within a value is doubled. An empty text
# cannot be told from null and comes back as null.
OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    mode: str = "PERMISSIVE",
    multi_line: bool = False,
) -> DataFrame:
    """``multi_line`` reads values with line breaks; such a file is read by one task."""
    reader = spark.read.schema(schema).options(**OPTIONS, header="true", mode=mode)
    return reader.option("multiLine", multi_line).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**OPTIONS, header="true").csv(path)


def to_csv_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Every row as one CSV line, without touching storage."""
    return df.select(F.to_csv(F.struct(*df.columns), OPTIONS).alias(name))


def from_csv_lines(lines: DataFrame, schema: StructType, name: str = "line") -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return lines.select(F.from_csv(F.col(name), F.lit(ddl), OPTIONS).alias("row")).select("row.*")
