"""Spelling variants: words within one edit of each other, and the frequent form that each leads to.

Words are counted over all documents. Of each pair within one edit, the edit
lies in one window of the shorter word, and what stands before and behind that
window is equal in both. Words therefore meet in groups of equal head, equal
tail and equal length of the shorter word, cut out of halves at first; groups
that are too large for a task are cut again, into halves of the window, until
they fit. A window of one code point holds no more words than there are letters.

Method within a group: the middles are scanned as a sorted list. A word's banded
edit matrix keeps one row per prefix; adjacent words share the rows up to their
longest common prefix, so that a row is computed once for the whole range of
words with that prefix, and a range is skipped once its row exceeds one edit.
Rows of many words and ranges are computed at a time, one code point deeper in
each step.

Defined results: a null or empty text has no words. Runs of rows without id are
taken as they are, without deletion; repeated rows count each time. Of equally
frequent near words the first in code-point order is the form. An empty table
gives no rows. Other columns of the table are left out, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.llm.words import partitions, stored

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How many times a form must be as frequent as the word.
TIMES = 10
#: One run in so many loses a code point.
DELETED_EACH = 31
#: Code points of a group, and words that look for others, that a task holds at once.
CELLS, LOOKING = 1 << 20, 1 << 13
_RUN = "[A-Za-zÀ-ÿ]"
_COUNTED_AT_ONCE = 1 << 18


def altered(run: str, start: int | None) -> str:
    """The run without the code point that its hash names, if it names one; `start` is the CRC of what the hash begins with."""
    if start is not None:
        hashed = zlib.crc32(run.encode(), start)
        if hashed % DELETED_EACH == 0:
            at = hashed % len(run)
            return run[:at] + run[at + 1 :]
    return run


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> word, n; a word may come several times."""
    long_run = re.compile(f"{_RUN}{{{LEAST_LENGTH},}}")

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    held: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
            # Bytes lower-case A-Z alone.
            for run, n in Counter(long_run.findall(text.encode().lower().decode())).items():
                word = altered(run, start)
                if len(word) >= LEAST_LENGTH:
                    held[word] += n
            if len(held) >= _COUNTED_AT_ONCE:
                yield told()
                held.clear()
    yield told()


def words_of(docs: DataFrame) -> DataFrame:
    """word and n of the words that are long and frequent enough."""
    counts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count_words, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def in_windows(words: DataFrame) -> DataFrame:
    """Each word once for either half in which an edit may lie, by the length of the shorter word of the pair.

    Columns: len (of the shorter word), head, tail, middle, n.
    """
    length = F.length("word")
    shorter = F.filter(F.array(length, length - 1), lambda n: n >= LEAST_LENGTH)
    rows = words.withColumn("len", F.explode(shorter))
    half = F.floor(F.col("len") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("from"), half.alias("to")),
        F.struct(half.alias("from"), F.col("len").alias("to")),
    )
    return cut(rows.select("len", F.lit("").alias("head"), F.lit("").alias("tail"), F.col("word").alias("middle"), "n", F.explode(sides).alias("side")))


def window() -> Column:
    """Length of the row's window in the shorter word."""
    return F.col("len") - F.length("head") - F.length("tail")


def cut(rows: DataFrame) -> DataFrame:
    """Rows whose window is the part `side` (from, to) of the window they had."""
    behind = window() - F.col("side.to")
    middle, size = F.col("middle"), F.length("middle")
    before = F.substr(middle, F.lit(1), F.col("side.from"))
    inner = F.substr(middle, F.col("side.from") + 1, size - F.col("side.from") - behind)
    after = F.substr(middle, size - behind + 1, behind)
    return rows.select("len", F.concat("head", before).alias("head"), F.concat(after, "tail").alias("tail"), inner.alias("middle"), "n")


def in_halves(rows: DataFrame) -> DataFrame:
    """Rows of windows of half the length; no edit is lost."""
    half = F.floor(window() / 2).cast("int")
    sides = F.array(F.struct(F.lit(0).alias("from"), half.alias("to")), F.struct(half.alias("from"), window().alias("to")))
    return cut(rows.withColumn("side", F.explode(sides)))


def near_in_list(codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of rows within one edit.

    `codes` holds a row of code points per middle, ended by -1, sorted within each
    group and distinct there; `ends` says for each row where its group ends.
    """
    n, width = codes.shape
    # Longest common prefix with the row before; -1 at a group's first row.
    differs = np.ones((n, width + 1), bool)
    differs[1:, :width] = codes[1:] != codes[:-1]
    common = differs.argmax(1)
    common[1:][ends[1:] != ends[:-1]] = -1
    common[:1] = -1
    left, right = [], []
    looking = np.flatnonzero(np.arange(n) + 1 < ends)
    for at in range(0, len(looking), LOOKING):
        i = looking[at : at + LOOKING]
        low, high = i + 1, ends[i]
        # Cells of the matrix's row on the diagonal and beside it, 2 for more than one edit.
        under, on, over = np.full(len(i), 2, np.int8), np.zeros(len(i), np.int8), np.where(lengths[i] >= 1, 1, 2).astype(np.int8)
        for depth in range(width):
            if not len(i):
                break
            # A range splits where words part at this depth.
            parts = np.flatnonzero(common <= depth)
            first, last = np.searchsorted(parts, low, "right"), np.searchsorted(parts, high, "left")
            count = last - first + 1
            row = np.repeat(np.arange(len(i)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            place = first[row] + step
            low = np.where(step == 0, low[row], parts[np.maximum(place - 1, 0)])
            high = np.where(step == count[row] - 1, high[row], parts[np.minimum(place, len(parts) - 1)])
            i, under, on, over = i[row], under[row], on[row], over[row]
            code, rest = codes[low, depth], lengths[i] - depth
            ended = code == -1
            distance = np.select([rest == -1, rest == 0, rest == 1], [under, on, over], 2)
            hit = ended & (distance == 1)
            left.append(i[hit])
            right.append(low[hit])
            one = np.int8(1)
            back = codes[i, depth - 1] if depth else np.full(len(i), -2, codes.dtype)
            same = codes[i, depth]
            ahead = codes[i, depth + 1] if depth + 1 < width else np.full(len(i), -2, codes.dtype)
            new_under = np.where(rest < 0, 2, np.minimum(under + (code != back), on + one))
            new_on = np.where(rest < 1, 2, np.minimum(np.minimum(on + (code != same), over + one), new_under + one))
            new_over = np.where(rest < 2, 2, np.minimum(over + (code != ahead), new_on + one))
            stay = ~ended & (np.minimum(np.minimum(new_under, new_on), new_over) <= 1)
            i, low, high = i[stay], low[stay], high[stay]
            under, on, over = (x[stay].astype(np.int8) for x in (new_under, new_on, new_over))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _code_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.full((len(texts), int(lengths.max(initial=0)) + 1), -1, np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    at = np.repeat(np.cumsum(lengths) - lengths, lengths)
    codes[np.repeat(np.arange(len(texts)), lengths), np.arange(len(flat)) - at] = flat
    return codes, lengths


def _near_of(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
    """All near pairs of the groups of the table, in both directions."""
    size, head, middle, tail, n = (table.column(c) for c in ("len", "head", "middle", "tail", "n"))
    codes, lengths = _code_rows(middle.to_pylist())
    i, j = near_in_list(codes, lengths, ends)
    fixed = pc.add(pc.utf8_length(head), pc.utf8_length(tail)).to_numpy().astype(np.int64)
    wide = size.to_numpy().astype(np.int64) - fixed
    # The shorter word must be of the group's length, and the first difference lie in this window: each pair comes once.
    parted = np.ones((len(i), codes.shape[1] + 1), bool)
    parted[:, :-1] = codes[i] != codes[j]
    last = pc.equal(pc.utf8_length(tail), 0).to_numpy()
    good = (np.minimum(lengths[i], lengths[j]) == wide[i]) & ((parted.argmax(1) < wide[i]) | last[i])
    i, j = i[good], j[good]
    words = pc.binary_join_element_wise(head, middle, tail, "").combine_chunks()
    one, other = np.concatenate([i, j]), np.concatenate([j, i])
    columns = [words.take(pa.array(one)), words.take(pa.array(other)), n.combine_chunks().take(pa.array(other))]
    return pa.RecordBatch.from_arrays(columns, names=["word", "other", "other_n"])


def near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of windows -> word, other, other_n for words within one edit."""
    held: pa.Table | None = None

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        new = _new_groups(table)
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(new)))
        # Words alone in their group are left out before anything is built for them.
        crowd = np.repeat(count > 1, count)
        table = table.filter(pa.array(crowd))
        count = count[count > 1]
        ends = np.cumsum(count)
        widths = pc.utf8_length(table.column("middle")).to_numpy().astype(np.int64) + 2
        at = 0
        while at < len(ends):
            low = int(ends[at] - count[at])
            most = np.maximum.accumulate(widths[low:])
            fits = (ends[at:] - low) * most[ends[at:] - low - 1] <= CELLS
            to = at + max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
            high = int(ends[to - 1])
            yield _near_of(table.slice(low, high - low), np.repeat(ends[at:to] - low, count[at:to]))
            at = to

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        new = np.flatnonzero(_new_groups(held))
        if len(new) and new[-1] > 0:
            yield from work(held.slice(0, int(new[-1])))
            held = held.slice(int(new[-1])).combine_chunks()
    if held is not None and held.num_rows:
        yield from work(held)


def _new_groups(table: pa.Table) -> np.ndarray:
    """Whether each row begins a group."""
    new = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        new[1:] = False
        for name in ("len", "head", "tail"):
            column = table.column(name).combine_chunks()
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return new


GROUP = ["len", "head", "tail"]


def near_words(words: DataFrame, cells: int = CELLS) -> DataFrame:
    """word, other, other_n for all pairs of words within one edit, in both directions."""
    spark, found = words.sparkSession, None
    rows = in_windows(words)
    group = F.xxhash64(*GROUP)
    while True:
        # Groups above the bound, by hash: few, and one of them splits a few others needlessly at worst.
        size = F.count("*") * (F.max(F.length("middle")) + 1)
        large = rows.groupBy(group.alias("_group")).agg(size.alias("_cells"), F.max(window()).alias("_wide"))
        large = stored(large.where((F.col("_cells") > cells) & (F.col("_wide") > 1)).select("_group"))
        more = not large.isEmpty()
        rest, whole = None, rows
        if more:
            marked = rows.withColumn("_group", group)
            whole = marked.join(large, "_group", "left_anti").drop("_group")
            rest = marked.join(large, "_group", "left_semi").drop("_group")
        dealt = whole.repartition(partitions(spark), *GROUP).sortWithinPartitions(*GROUP, "middle")
        pairs = stored(dealt.mapInArrow(near_pairs, "word string, other string, other_n long"))
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found
        # A word alone in its window is parted from a window's others, so windows of one code point are not cut.
        keep = stored(rest)
        rows = in_halves(keep.where(window() > 1)).unionByName(keep.where(window() <= 1))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the last of the forms that begin at the word.

    A form is TIMES as frequent as its word, so no chain has more than 19 words;
    each round doubles the steps that are taken.
    """
    found = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = found.join(further, F.col("root") == F.col("_word"), "left")
        moved = stored(moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_on")))
        found = moved.drop("_on")
        if moved.where("_on").isEmpty():
            return found


def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word."""
    words = stored(words_of(docs))
    near = near_words(words)
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("_best")
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    taken = -F.col("_best.n") >= TIMES * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(taken, F.col("_best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(taken, -F.col("_best.n")).alias("form_n"),
        )
    )
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
