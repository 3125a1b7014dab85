"""Scoring of texts by a language model trained on the corpus, beside a word-frequency baseline.

All training documents are counted: the words for the baseline and, through
the words, the subword ids for the model's vocabulary. The attention model
learns in numpy from every window of every training document: in each round all
partitions train on their own documents of that round, and the weights, whose
number is fixed, are averaged. The model then scores every document whole.

A text is its words (A-Z lower-cased) and one end. The model sees the ids of
each word after a space, and the end id; a word's ids do not depend on its
neighbours, and the product over all ids is the text's probability.

Defined results: a null or empty text is the end alone. Repeated rows are
scored each, and count each in training. A null id is not held out. Without
training documents the baseline is 0 and the model untrained. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.llm import attention
from jornada.llm.packing import PATTERN, RANKS
from jornada.llm.words import stored, words

FOLDS, HELD_OUT = 7, 2
END_ID, IDS = 50256, 50257
#: Words whose counts every task holds; the counts of all others are joined.
COMMON_WORDS = 200_000
#: Rounds of training, which part the documents; the weights are averaged after each.
ROUNDS = 6
#: Windows that a task mixes at a time, and that make a task of a round worthwhile.
MIXED, LEAST_WINDOWS = 16_384, 6400
#: Pieces in which the weights are averaged.
PIECES = 24
_END = b"\n"
_END_IDS = np.array([END_ID], np.uint16).tobytes()
_WORDS_HELD = 300_000
_LONGEST_HELD = 64
_IDS_AT_ONCE = 100_000


class Subwords(dict):
    """The ids of each word after a space, as bytes of 16-bit numbers; words met before are looked up."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, word: bytes) -> bytes:
        found = array("H", self.encoding.encode_ordinary(" " + word.decode())).tobytes()
        if len(word) <= _LONGEST_HELD:
            if len(self) >= _WORDS_HELD:
                self.clear()
            self[word] = found
        return found


@functools.lru_cache(maxsize=2)
def subwords(ranks: str) -> tuple[Subwords, np.ndarray]:
    """The tokenizer of words, and which ids open a word."""
    with open(ranks, "rb") as lines:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    opens = np.zeros(IDS, np.int64)
    for text, number in known.items():
        opens[number] = text.startswith(b" ")
    return Subwords(tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})), opens


def ids_of(encoding: Subwords, own: list[bytes]) -> np.ndarray:
    """The ids of a text's words and the end id."""
    ids = np.frombuffer(b"".join(map(encoding.__getitem__, own)), np.uint16)
    return np.append(ids, np.uint16(END_ID)).astype(np.int32)


def stored_ids(value: pa.BinaryScalar) -> np.ndarray:
    """A text's ids from their bytes in a table."""
    return np.frombuffer(value.as_buffer(), np.uint16).astype(np.int32)


def word_number(word: bytes) -> int:
    """64 bits that stand for a word in joins, as Spark's xxhash64 gives them."""
    found = xxhash.xxh64_intdigest(word, seed=42)
    return found - (1 << 64) if found >> 63 else found


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def turn_of() -> Column:
    """The round in which a text is learned from."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary), number and count over all texts; the end is the word of one line feed.

    Every task counts before the shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "times"])

        for given in batches:
            for text in given.column(0):
                held.update(words(text.as_py()))
                held[_END] += 1
                if len(held) > _WORDS_HELD:
                    yield batch()
                    held = Counter()
        if held:
            yield batch()

    partial = texts.select("text").mapInArrow(work, "word binary, times long")
    found = partial.groupBy("word").agg(F.sum("times").alias("times"))
    return found.select("word", F.xxhash64("word").alias("number"), "times")


def id_counts(counts: DataFrame, ranks: str) -> np.ndarray:
    """How often each subword id occurs in the corpus, from its words: one number per id of the vocabulary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = subwords(ranks)
        total = np.zeros(IDS, np.int64)
        for given in batches:
            own = [_END_IDS if word == _END else encoding[word] for word in given.column(0).to_pylist()]
            lengths = [len(ids) // 2 for ids in own]
            times = np.repeat(given.column(1).to_numpy(), lengths)
            np.add.at(total, np.frombuffer(b"".join(own), np.uint16), times)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["id", "times"])

    partial = counts.select("word", "times").mapInArrow(work, "id long, times long")
    found = np.zeros(IDS, np.int64)
    for row in partial.groupBy("id").agg(F.sum("times").alias("times")).collect():
        found[row["id"]] = row["times"]
    return found


def learned(
    texts: DataFrame,
    start: attention.Attention,
    vocabulary: attention.Vocabulary,
    ranks: str,
    least: int,
    rate: float,
    before: float = 0,
) -> DataFrame:
    """Rows (piece, task, weights, counts): the weights after each task has learned from all of its texts, in pieces.

    The texts may come as their `ids`, as `encoded` gives them. A task holds so many windows as it mixes at a time. It learns from them once,
    or, where a least number of steps is asked for, again up to it. `before` is how
    many windows the start has been learned from, per task.
    """
    shared = texts.sparkSession.sparkContext.broadcast((start, vocabulary))
    column = "ids" if "ids" in texts.columns else "text"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vocabulary = shared.value
        task = TaskContext.get().partitionId()
        random = np.random.default_rng(task)
        trainer = attention.Trainer(attention.from_flat(attention.flat_of(known)), vocabulary)
        waiting: list[np.ndarray] = []
        held, learned_from = 0, before

        def learn(windows: np.ndarray) -> None:
            nonlocal learned_from
            until = trainer.steps + max(1, least)
            while trainer.steps < until:
                order = random.permutation(len(windows))
                while len(order):
                    many = attention.batch_after(learned_from)
                    # No step is made of a small rest.
                    many = many if len(order) >= 1.5 * many else len(order)
                    trainer.step(windows[order[:many]], rate)
                    learned_from += many
                    order = order[many:]

        for given in batches:
            for text in given.column(0):
                ids = stored_ids(text) if column == "ids" else ids_of(subwords(ranks)[0], words(text.as_py()))
                own = attention.windows_of(np.concatenate([[END_ID], ids]))
                for i in range(0, len(own), MIXED):
                    waiting.append(own[i : i + MIXED])
                    held += len(waiting[-1])
                    if held >= MIXED:
                        learn(np.concatenate(waiting))
                        waiting, held = [], 0
        if held:
            learn(np.concatenate(waiting))
        if trainer.steps:
            values, counts = (np.array_split(x, PIECES) for x in trainer.weights())
            columns = [
                pa.array(range(PIECES), pa.int32()),
                pa.array([task] * PIECES, pa.int32()),
                pa.array([x.tobytes() for x in values], pa.binary()),
                pa.array([x.tobytes() for x in counts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "task", "weights", "counts"])

    return texts.select(column).mapInArrow(work, "piece int, task int, weights binary, counts binary")


def averaged(rows: DataFrame, start: attention.Attention) -> attention.Attention:
    """The mean of all tasks' weights, each by how often the task learned from it; only the means come to the driver.

    So an id that few tasks have seen is as those tasks have learned it. What
    none has seen stays.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for given in batches:
            for piece, weights, counts in zip(given.column(0).to_pylist(), given.column(2), given.column(3)):
                counts = np.frombuffer(counts.as_buffer(), np.float32).astype(np.float64)
                own = np.stack([np.frombuffer(weights.as_buffer(), np.float32) * counts, counts])
                total[piece] = total[piece] + own if piece in total else own
        columns = [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["piece", "total"])

    # Sorted, so that sums do not depend on which task ends first.
    dealt = rows.repartition(PIECES, "piece").sortWithinPartitions("piece", "task")
    found = {r["piece"]: np.frombuffer(r["total"]).reshape(2, -1) for r in dealt.mapInArrow(work, "piece int, total binary").collect()}
    if not found:
        return start
    total, counts = np.concatenate([found[i] for i in range(PIECES)], axis=1)
    return attention.from_flat(np.where(counts > 0, total / np.maximum(counts, 1), attention.flat_of(start)))


def fitted(texts: DataFrame, vocabulary: attention.Vocabulary, ranks: str, n_ids: int, steps: int = 0) -> attention.Attention:
    """The model, learned from all windows of all texts, which hold `n_ids` ids: once, whatever the size of the corpus.

    A hash deals the texts out to rounds; texts that come as `ids` bring their
    `turn`. A round has as many tasks as there are
    partitions, or fewer for so few windows that a task would hardly make a step.
    Where `steps` are asked for, each task makes that many over all rounds, if
    need be by learning again.
    """
    windows = n_ids // attention.WINDOW + 1
    tasks = max(1, windows // (ROUNDS * LEAST_WINDOWS))
    place = F.col("turn") if "turn" in texts.columns else turn_of()
    model = attention.Attention.at_frequencies(vocabulary)
    for turn in range(ROUNDS):
        rate = attention.RATE * (1 - turn / ROUNDS) ** 0.5
        own = texts.filter(place == turn).coalesce(tasks)
        model = averaged(learned(own, model, vocabulary, ranks, steps // ROUNDS, rate, turn * windows / (ROUNDS * tasks)), model)
    return model


def most_common(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words of the highest counts, all of them down to a count, so that there are at most `most`.

    The count is found from the numbers of words by eighths of powers of two,
    so that only the chosen words leave their tasks.
    """
    band = F.floor(F.log2("times") * 8).cast("int")
    room, lowest = most, None
    for row in counts.groupBy(band.alias("band")).agg(F.count("*").alias("n")).orderBy(F.col("band").desc()).collect():
        if row["n"] > room:
            break
        room, lowest = room - row["n"], row["band"]
    if lowest is None:
        return {}
    return {bytes(r["word"]): r["times"] for r in counts.filter(band >= lowest).select("word", "times").collect()}


def encoded(docs: DataFrame, ranks: str, common: dict[bytes, int], complete: bool) -> DataFrame:
    """Of each document (doc_id, text, held_out) its round, its ids, and what the baseline needs.

    doc_id, held_out, turn, n_tokens, then over the `common` words alone n_known
    and known_sum (of log10(count + 1)), then ids (16 bits each) and others: the
    numbers of all other words, none if the common words are `complete`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = subwords(ranks)
        logs = {word: float(np.log10(times + 1)) for word, times in shared.value.items()}
        for given in batches:
            n_tokens, n_known, base, ids, others = [], [], [], [], []
            for text in given.column(3):
                own = words(text.as_py())
                ids.append(b"".join(map(encoding.__getitem__, own)) + _END_IDS)
                own.append(_END)
                found = list(map(logs.get, own))
                rest = [w for w, x in zip(own, found) if x is None] if None in found else []
                n_tokens.append(len(own))
                n_known.append(len(own) - len(rest))
                base.append(sum(filter(None, found)))
                others.append([] if complete else list(map(word_number, rest)))
            columns = [
                *given.columns[:3],
                pa.array(n_tokens, pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(ids, pa.binary()),
                pa.array(others, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "held_out", "turn", "n_tokens", "n_known", "known_sum", "ids", "others"]
    kinds = "doc_id long, held_out boolean, turn long, n_tokens long, n_known long, known_sum double, ids binary, others array<long>"
    return docs.select("doc_id", "held_out", turn_of().alias("turn"), "text").mapInArrow(work, kinds)


def scored(coded: DataFrame, model: attention.Attention, vocabulary: attention.Vocabulary) -> DataFrame:
    """The rows with the score of their ids in place of these, and without the other words."""
    shared = coded.sparkSession.sparkContext.broadcast((model, vocabulary))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary = shared.value
        scorer = attention.Scorer(model)
        for given in batches:
            waiting: list[np.ndarray] = []
            held = 0
            scores: list[np.ndarray] = []
            for value in given.column(len(kept)):
                waiting.append(stored_ids(value))
                held += len(waiting[-1])
                if held > _IDS_AT_ONCE:
                    scores.append(attention.score(scorer, vocabulary, waiting, END_ID))
                    waiting, held = [], 0
            scores.append(attention.score(scorer, vocabulary, waiting, END_ID))
            columns = [*given.columns[: len(kept)], pa.array(np.concatenate(scores), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score"])

    kept = ["_row", "doc_id", "held_out", "n_tokens", "n_known", "known_sum"]
    kinds = "_row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_sum double, score double"
    return coded.select(*kept, "ids").mapInArrow(work, kinds)


def score_texts(
    docs: DataFrame,
    ranks: str = RANKS,
    steps: int = 0,
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document.

    The texts are read once to count their words and once to encode them; the
    rounds and the scores read the stored ids, 2 bytes each. Texts do not move.
    The counts of the most common words go to all tasks (a bounded table); the
    other words of each document are joined with their counts by hash.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text", held_out().alias("held_out"))
    counts = stored(word_counts(docs.filter(~F.col("held_out"))))
    told = counts.agg(F.sum("times").alias("n"), F.count("*").alias("v")).first()
    n, v = told["n"] or 0, told["v"]
    opens = subwords(ranks)[1]
    ids = id_counts(counts, ranks)
    vocabulary = attention.vocabulary(ids, opens)
    common = most_common(counts, common_words)
    coded = stored(encoded(docs, ranks, common, len(common) == v).withColumn("_row", F.monotonically_increasing_id()))
    model = fitted(coded.filter(~F.col("held_out")), vocabulary, ranks, int(ids.sum()), steps)
    rows = stored(scored(coded, model, vocabulary))
    asked = coded.select("_row", F.explode("others").alias("number"))
    asked = asked.groupBy("_row", "number").agg(F.count("*").alias("here"))
    found = asked.join(counts.select("number", "times").hint("merge"), "number")
    found = found.groupBy("_row").agg(
        F.sum("here").alias("_known"), F.sum(F.col("here") * F.log10(F.col("times") + 1)).alias("_sum")
    )
    rows = rows.join(found.hint("merge"), "_row", "left")
    total = F.col("known_sum") + F.coalesce("_sum", F.lit(0.0))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (total - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        "score",
    )
