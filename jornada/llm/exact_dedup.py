"""Exact dedup against a persistent index of digests.

The index is a table bucketed and sorted by digest. A batch is reduced to one
row per digest, an anti-join with the index (sort-merge, without a shuffle of
the index) leaves the new ones, and those are appended. A text stays if its
digest was new and its row has the smallest doc_id of the batch's copies.

Texts are equal when they are after every run of blanks, tabs and line ends
has become one space.

Defined results: a null text counts as an empty one. A null doc_id comes after
all others. Of repeated rows with the same doc_id and text one stays. An empty
batch appends nothing. A batch that is given again finds all its digests in the
index, so a run that died may be repeated; nothing of it stays then. Other
columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.llm.words import or_empty, partitions, shared_folder, stored
from jornada.sources.files import exists

LAST = (1 << 63) - 1


class DigestIndex:
    """Digests seen so far, in a folder that all executors share.

    `buckets` counts when the folder is new; it is kept next to the data, so the
    index opens again in another session.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder, self.name = spark, folder, f"digest_index_{uuid.uuid4().hex}"
        if exists(spark, f"{folder}/layout/_SUCCESS"):
            buckets = spark.read.schema("buckets int").json(f"{folder}/layout").first()[0]
        else:
            buckets = buckets or partitions(spark)
            layout = spark.range(1).select(F.lit(buckets).alias("buckets"))
            layout.write.mode("overwrite").json(f"{folder}/layout")
        self.buckets = buckets
        spark.sql(
            f"create table {self.name} (digest binary, keep_id bigint) using parquet "
            f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{folder}/data'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Adds the digests that are not there yet; `groups` has each digest once."""
        fresh = groups.select("digest", "keep_id").join(self.table().hint("merge"), "digest", "left_anti")
        # The exchange deals rows out as buckets are, so each task writes the files of its own buckets.
        fresh.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Takes the table out of the session's catalog; its files stay, and the index can be opened again."""
        self.spark.sql(f"drop table if exists {self.name}")


def normalised(text: str = "text"):
    return F.regexp_replace(or_empty(text), r"[\x20\x09-\x0D]+", " ")


def dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept, digest; the index has grown by the new digests.

    keep_id is the row that stays for this digest, from an earlier batch too;
    group_size counts the rows of this batch. The result is read from tables of
    its own, so the index may be closed before it.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long"),
            F.unhex(F.sha2(normalised(), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)), F.col("_row"))
    groups = rows.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.min(place)["_row"].alias("_first"), F.count("*").alias("group_size")
    )
    groups = stored(groups.join(index.table().select("digest", F.lit(True).alias("_known")).hint("merge"), "digest", "left"))
    index.append(groups)
    ends = groups.drop("keep_id").join(index.table().hint("merge"), "digest")
    # Written before the join with all rows, so that both its sides are dealt out and a hot digest can be split.
    ends = stored(ends)
    return rows.join(ends.hint("merge"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("_known").isNull() & (F.col("_row") == F.col("_first"))).alias("kept"),
        "digest",
    )


def scratch_index(spark: SparkSession) -> DigestIndex:
    """A new index below the shared folder, for a single batch."""
    return DigestIndex(spark, f"{shared_folder(spark)}/digest-index-{uuid.uuid4().hex}")
