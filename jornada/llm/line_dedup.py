"""Removal of lines that several documents share.

The normalised lines of each document are exploded to hashes, each hash gets
its number of documents and its first holder, and the documents are put
together again by position without the lines that lie over the threshold.

A line's key is the line without blanks at either end, with A-Z lower-cased.
Keys are told apart by 128 bits of a hash.

Defined results: a null or empty text is one empty line and stays. Lines with
short keys always stay. Of rows with the same doc_id all count as one document;
a null id counts as one document after all others. Repeated lines within the
first holder stay. Other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.llm.words import stored

LEAST_CHARS = 10
LEAST_DOCS = 2
_LAST = (1 << 63) - 1


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def line_hash(line: bytes, least_chars: int) -> bytes | None:
    """128 bits for the line's key, or nothing where the key is too short to count."""
    key = line_key(line)
    return xxhash.xxh3_128_digest(key) if len(key) >= least_chars and code_points(key) >= least_chars else None


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """A row (hash, holder, own) for each distinct line of each row of documents; `own` tells texts of a holder apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            ids, rows, hashes = [], [], []
            for holder, row, text in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), given.column(2)):
                own = {line_hash(x, least_chars) for x in (text.as_py() or "").encode().split(b"\n")}
                own.discard(None)
                hashes.extend(own)
                ids.extend([holder] * len(own))
                rows.extend([row] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64())],
                names=["hash", "holder", "own"],
            )

    return docs.select(*_keys(), "text").mapInArrow(work, "hash binary, holder long, own long")


def _keys() -> list[Column]:
    """The holder of a row's lines, and a hash of its text: what rows of one holder lose stays apart by it.

    Texts with the same hash by chance share what they lose, which is right for
    both, since a line's loss depends on the holder alone.
    """
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("holder"), F.xxhash64("text").alias("own")]


def shared_lines(hashes: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Hashes found in at least so many documents: hash, n_docs, first holder.

    The totals are formed in the map tasks first. With the threshold 2, the
    first and the last holder tell whether there are two documents; any other
    threshold counts the distinct holders, which first makes them distinct.
    """
    if least_docs <= 2:
        found = hashes.groupBy("hash").agg(F.min("holder").alias("first"), F.max("holder").alias("last"))
        return found.filter(F.col("first") < F.col("last") if least_docs == 2 else F.lit(True)).select("hash", "first")
    found = hashes.select("hash", "holder").distinct().groupBy("hash").agg(F.min("holder").alias("first"), F.count("*").alias("n_docs"))
    return found.filter(F.col("n_docs") >= least_docs).select("hash", "first")


def lost_lines(hashes: DataFrame, shared: DataFrame) -> DataFrame:
    """holder, own and the hashes that they lose: never more than the lines of one text, however many a holder has."""
    lost = hashes.join(shared.hint("merge"), "hash").filter(F.col("holder") > F.col("first"))
    return lost.groupBy("holder", "own").agg(F.collect_set("hash").alias("__drop"))


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents with their other columns, the text reassembled, and n_lines and n_dropped.

    A hash that many documents share is joined by Spark's sort-merge join, whose
    hot partitions it can split. The lines to drop are gathered per text,
    never per line, nor over all rows without an id.
    """
    hashes = line_hashes(docs, least_chars)
    # Written first: both sides of the join are then dealt out by it, and a hot hash can be split.
    shared = stored(shared_lines(hashes, least_docs))
    losing = lost_lines(hashes, shared).withColumnsRenamed({"holder": "__loser", "own": "__lost"})
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    holder, own = _keys()
    rows = docs.select(*names, holder.alias("__holder"), own.alias("__own"))
    same = (F.col("__holder") == F.col("__loser")) & (F.col("__own") == F.col("__lost"))
    rows = rows.join(losing.hint("merge"), same, "left")

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def reassemble(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
        out = []
        for own, gone in zip(text, drop):
            own = own or ""
            if gone is None or not len(gone):
                out.append((own, own.count("\n") + 1, 0))
                continue
            gone = {bytes(x) for x in gone}
            lines = own.encode().split(b"\n")
            kept = [x for x in lines if line_hash(x, least_chars) not in gone]
            out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    done = rows.withColumn("__done", reassemble("text", "__drop"))
    return done.select(
        *[F.col("__done.text").alias("text") if c == "text" else F.col(c) for c in names],
        F.col("__done.n_lines").alias("n_lines"),
        F.col("__done.n_dropped").alias("n_dropped"),
    )
