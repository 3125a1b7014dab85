"""Packing by power-of-two decomposition.

Every document becomes its token ids and an end id. It is cut into pieces of
2048 ids while it lasts and the rest into its binary digits (1024, 512, ...),
so each piece is a sequence of its own in the bucket of its length: nothing is
padded and no sequence holds two documents.

Defined results: a null text is an empty one, whose only piece is the end id. A
repeated row is packed again. Rows with a null id keep the null. An empty table
gives no pieces. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST = 2048
END_ID = 1
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, offset long, ids binary"
)
#: Texts beyond these letters, or with the special token or very long runs, go to the slower library.
UNUSUAL = re.compile(r"[^\x00-ɏ]|<\|endoftext\|>|\s{500}|\w{5000}")
FLUSH_BYTES = 16 << 20


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str | None):
    """A function from a text to its ids; built once per worker.

    The ids are those of `tokenizers`. Where the vocabulary is also given as
    ranks, `tiktoken` gives the same ids about four times faster and takes the
    usual texts.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if ranks is None:
        return slow
    import tiktoken

    with open(ranks, "rb") as lines:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(text: str) -> list[int]:
        return slow(text) if UNUSUAL.search(text) else fast.encode_ordinary(text)

    return encode


def cuts(total: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of so many tokens; `longest` is a power of two."""
    found = [(start, longest) for start in range(0, total - longest + 1, longest)]
    start, rest = len(found) * longest, total % longest
    while rest:
        length = 1 << (rest.bit_length() - 1)
        found.append((start, length))
        start, rest = start + length, rest - length
    return found


def pack(
    docs: DataFrame,
    longest: int = LONGEST,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    ranks: str | None = RANKS,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, offset, ids, bucket, sequence_id.

    `ids` holds little-endian unsigned 32-bit ids, as training files do. Each
    piece is the whole of its sequence, so its offset is 0. There is no shuffle.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            ids, starts, lengths, totals, pieces = zip(*rows)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
            columns = ids, starts, lengths, totals, [0] * len(rows), pieces
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "start", "length", "doc_tokens", "offset", "ids"],
            )

        for given in batches:
            for doc_id, text in zip(given.column(0), given.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                packed = np.array(ids, "<u4").tobytes()
                number = doc_id.as_py()
                for start, length in cuts(len(ids), longest):
                    rows.append((number, start, length, len(ids), packed[4 * start : 4 * (start + length)]))
                    held += 4 * length
                    if held > FLUSH_BYTES:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()

    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, PIECES)
    return pieces.withColumn("bucket", F.log2("length").cast("int")).withColumn(
        "sequence_id", F.monotonically_increasing_id()
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Stores the sequences in one folder per length, from which batches of equal lengths are drawn."""
    pieces.write.partitionBy("bucket").parquet(path)
