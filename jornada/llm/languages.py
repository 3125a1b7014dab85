"""Language identification with spans: scripts narrow the candidates, Viterbi decides word by word.

A word is a run of letters of one script. Its script's code points narrow the
languages to those that are written in it; every candidate scores the word by
the logarithms of its character n-grams' shares. Viterbi over the words of a
text, with a penalty for each switch, labels spans of mixed-language text. A
text's language is the one with most letters in its spans; the score weighs
each of its spans by the certainty of its label.

The model is a table of BUCKETS logarithms per language, counted over all
documents that may be learned from, so it grows with the number of languages
and not with the corpus.

Defined results: a text that is null or has no letter is "und" with score 0 and
no spans; so is every text when nothing could be learned (no rows, or none with
a text with letters and a language). Letters of a script that no learned
language uses favour no language. Ties go to the first language in code-point
order. Rows without id, or with a repeated one, are labelled like any other;
rows without id are not learned from. An empty table gives no rows. Other
columns are left out, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.llm.words import texts_of

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
BITS = 16
BUCKETS = 1 << BITS
SIZES = (2, 3, 4)
#: What a switch of the language costs, in the unit of a word's score (natural logarithm).
SWITCH = 8.0
#: A script counts for a language from this share of its letters on.
LEAST_SHARE = 0.01
SMOOTHING = 0.5
#: Code points times languages, and words, that a task holds at once.
CELLS, WORDS = 1 << 22, 1 << 20

# Scripts by their ranges of code points (first, last); all other letters are one more script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
_OTHER = len(SCRIPTS) + 1
_MARK = 255


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script of each code point (0: no letter, _MARK: a mark that belongs to the letter before), and its small letter."""
    script = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            script[code] = _OTHER
        elif kind == "M":
            script[code] = _MARK
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            part = script[first : last + 1]
            part[part == _OTHER] = number
    small = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x20000):
        lower = chr(code).lower()
        if len(lower) == 1:
            small[code] = ord(lower)
    return script, small


@dataclass(frozen=True)
class Words:
    """Words of a piece of text: where they start and end, their script and letters, and the places of n-grams."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray

    def ngrams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of the n-gram that ends at each place, and whether there is one: letters, perhaps with the blank on either side."""
        codes, n = self.codes, len(self.codes)
        value = np.full(n, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        there = np.zeros(n, bool)
        there[size - 1 :] = True
        letter = codes != 32
        for back in range(size - 1, -1, -1):
            value[back:] = (value[back:] ^ codes[: n - back]) * np.uint32(0x85EBCA6B)
            value ^= value >> np.uint32(13)
            if 0 < back < size - 1:
                there[back:] &= letter[: n - back]
        if size == 2:
            there[1:] &= letter[1:] | letter[:-1]
        return (value * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS), there


def words_in(codes: np.ndarray) -> Words:
    """The words of code points; a blank is put before and behind, which the places do not count."""
    scripts, small = _tables()
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    script = scripts[codes]
    if (script == _MARK).any():
        script = script[np.maximum.accumulate(np.where(script != _MARK, np.arange(len(script)), 0))]
    letter = script != 0
    codes = np.where(letter, small[codes], np.uint32(32))
    change = script[1:] != script[:-1]
    start = np.flatnonzero(change & letter[1:]) + 1
    end = np.flatnonzero(change & letter[:-1]) + 1
    return Words(codes, start, end, script[start] if len(start) else np.zeros(0, np.uint8))


def pieces(text: str, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """The text's code points in pieces of about `most` that end between words, each with its place; a longer word is cut."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = 0
    while len(codes) - at > most:
        gaps = np.flatnonzero(_tables()[0][codes[at : at + most]] == 0)
        step = int(gaps[-1]) + 1 if len(gaps) else most
        yield at, codes[at : at + step]
        at += step
    yield at, codes[at:]


def _joined(texts: Iterator[tuple[int, str]], most: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Lists of (row, place in the row's text, code points) of about `most` code points each."""
    held, size = [], 0
    for row, text in texts:
        for at, codes in pieces(text, most):
            held.append((row, at, codes))
            size += len(codes) + 1
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _laid_out(parts: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The parts' code points in one array with a blank behind each, and where each part begins there."""
    lengths = np.array([len(c) + 1 for _, _, c in parts])
    codes = np.full(lengths.sum(), 32, np.uint32)
    begin = np.cumsum(lengths) - lengths
    for at, (_, _, own) in zip(begin, parts):
        codes[at : at + len(own)] = own
    return codes, begin


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> counts (lang, feature, n); features from BUCKETS on are letters by script."""
    held: dict[str, np.ndarray] = {}

    def told() -> pa.RecordBatch:
        feature = [np.flatnonzero(v) for v in held.values()]
        langs = np.repeat(np.arange(len(held)), [len(f) for f in feature])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(held), pa.string()).take(pa.array(langs)),
                pa.array(np.concatenate(feature), pa.int32()),
                pa.array(np.concatenate([v[f] for v, f in zip(held.values(), feature)]), pa.int64()),
            ],
            names=["lang", "feature", "n"],
        )

    for batch in batches:
        langs = batch.column(0).to_pylist()
        by_lang: dict[str, list[int]] = {}
        for row, lang in enumerate(langs):
            by_lang.setdefault(lang, []).append(row)
        texts = batch.column(1)
        for lang, rows in by_lang.items():
            if lang not in held and len(held) == 64:
                yield told()
                held.clear()
            counts = held.setdefault(lang, np.zeros(BUCKETS + 256, np.int64))
            own = ((row, texts[row].as_py()) for row in rows)
            for parts in _joined(own, CELLS // 4):
                words = words_in(_laid_out(parts)[0])
                for size in SIZES:
                    bucket, there = words.ngrams(size)
                    counts[:BUCKETS] += np.bincount(bucket[there], minlength=BUCKETS)
                letters = np.bincount(words.script, words.end - words.start, minlength=256)
                counts[BUCKETS:] += letters.astype(np.int64)
    if held:
        yield told()


@dataclass(frozen=True)
class Model:
    """Learned languages in code-point order, logarithms of n-gram shares, and which scripts each language uses."""

    langs: tuple[str, ...]
    logs: np.ndarray
    uses: np.ndarray


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the row must not be learned from by its id; a row without id is not of this fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """Counts n-grams and scripts per language over all documents that may be learned from."""
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.select("lang", "text").mapInArrow(count_features, "lang string, feature int, n long")
    # At most BUCKETS + 256 rows per language reach the driver.
    counts = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    return model_of(counts["lang"].to_pylist(), counts["feature"].to_numpy(), counts["n"].to_numpy())


def model_of(lang: list[str], feature: np.ndarray, n: np.ndarray) -> Model:
    langs = tuple(sorted(set(lang)))
    number = {name: i for i, name in enumerate(langs)}
    table = np.zeros((BUCKETS + 256, len(langs)))
    table[feature, [number[x] for x in lang]] = n
    grams, letters = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    logs = np.log(grams / grams.sum(0)) / len(SIZES)
    uses = letters >= LEAST_SHARE * np.maximum(letters.sum(0), 1)
    logs -= logs.mean(1, keepdims=True) if langs else 0
    return Model(langs, logs.astype(np.float32), uses)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Score of each word for each language; languages that do not use its script are ruled out."""
    total = np.zeros((len(words.codes), len(model.langs)), np.float64)
    for size in SIZES:
        bucket, there = words.ngrams(size)
        total[there] += model.logs[bucket[there]]
    total = np.cumsum(total, axis=0)
    # The blank behind a word ends its last n-grams; a word of another script may follow without one.
    last = np.where(words.codes[words.end] == 32, words.end, words.end - 1)
    scores = total[last] - total[words.start - 1]
    uses = model.uses[words.script]
    some = uses.any(1)
    scores[~some] = 0
    scores[some & ~uses.all(1)] -= 1e4 * ~uses[some & ~uses.all(1)]
    return scores


def best_path(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi over the words of several texts at once: the language of each word.

    `scores` holds the words of all texts one after the other, `counts` words per
    text. Step t moves all texts that have a word t.
    """
    n_langs = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    length = counts[order]
    active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")
    state = np.zeros((len(order), n_langs))
    came = np.zeros(scores.shape, np.uint8 if n_langs < 256 else np.int32)
    own = np.arange(n_langs, dtype=came.dtype)
    for t, k in enumerate(active):
        at, now = first[:k] + t, state[:k]
        if t:
            from_ = now.argmax(1)
            now -= now[np.arange(k), from_][:, None]
            came[at] = np.where(now < -switch, from_[:, None].astype(came.dtype), own)
            np.maximum(now, -switch, out=now)
        now += scores[at]
    path = np.zeros(len(scores), np.int64)
    label = state.argmax(1) if n_langs else np.zeros(len(order), np.int64)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        path[at] = label[:k]
        label[:k] = came[at, label[:k]]
    return path


@dataclass(frozen=True)
class _Scored:
    """Words of some rows: row, place of the first and behind the last code point, letters, scores."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    scores: np.ndarray


def _scored(parts: list[tuple[int, int, np.ndarray]], model: Model) -> _Scored:
    codes, begin = _laid_out(parts)
    words = words_in(codes)
    start, end = words.start - 1, words.end - 1
    part = np.searchsorted(begin, start, "right") - 1
    rows, places = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    shift = (places - begin)[part]
    return _Scored(rows[part], start + shift, end + shift, word_scores(words, model))


def _spans(found: _Scored, model: Model, n_rows: int, switch: float) -> dict[str, np.ndarray]:
    """Spans of the words' rows: row, start, end, language, letters and certainty."""
    counts = np.bincount(found.row, minlength=n_rows)
    path = best_path(found.scores, counts, switch)
    new = np.ones(len(path), bool)
    new[1:] = (path[1:] != path[:-1]) | (found.row[1:] != found.row[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(path)) - 1
    sums = np.add.reduceat(found.scores, at, axis=0) if len(at) else found.scores
    sums = np.exp(np.maximum(sums - sums.max(1, keepdims=True), -700)) if len(at) else sums
    label = path[at]
    return {
        "row": found.row[at],
        "start": found.start[at],
        "end": found.end[last],
        "lang": label,
        "letters": np.add.reduceat(found.end - found.start, at) if len(at) else at,
        "score": sums[np.arange(len(at)), label] / sums.sum(1) if len(at) else np.zeros(0),
    }


def label_batch(texts: list[str], model: Model, switch: float = SWITCH) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """Language and score of each text, and all spans."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    empty = np.zeros(0, np.int64)
    all_spans = [dict.fromkeys(("row", "start", "end", "lang", "letters", "score"), empty)]
    if model.langs:
        def close(held: list[_Scored]) -> None:
            found = _Scored(*[np.concatenate([getattr(h, f) for h in held]) for f in ("row", "start", "end", "scores")])
            lowest = int(found.row[0])
            rows = found.row - lowest
            spans = _spans(_Scored(rows, found.start, found.end, found.scores), model, int(rows.max()) + 1, switch)
            weight = np.zeros((int(rows.max()) + 1, len(model.langs)))
            np.add.at(weight, (spans["row"], spans["lang"]), spans["letters"])
            sure = np.zeros_like(weight)
            np.add.at(sure, (spans["row"], spans["lang"]), spans["letters"] * spans["score"])
            for row in np.unique(rows):
                best = int(weight[row].argmax())
                langs[lowest + row] = model.langs[best]
                scores[lowest + row] = sure[row, best] / weight[row].sum()
            all_spans.append(spans | {"row": spans["row"] + lowest})

        held, size = [], 0
        for parts in _joined(enumerate(texts), max(1 << 12, CELLS // len(model.langs))):
            found = _scored(parts, model)
            # A row's words stay together: the last row may go on in the next parts.
            if size >= WORDS and len(found.row):
                cut = int(np.searchsorted(found.row, found.row[0], "right")) if found.row[0] == held[-1].row[-1] else 0
                if cut < len(found.row):
                    held.append(_Scored(found.row[:cut], found.start[:cut], found.end[:cut], found.scores[:cut]))
                    close(held)
                    held, size = [], 0
                    found = _Scored(found.row[cut:], found.start[cut:], found.end[cut:], found.scores[cut:])
            if len(found.row):
                held.append(found)
                size += len(found.row)
        if held:
            close(held)
    spans = {name: np.concatenate([s[name] for s in all_spans]) for name in all_spans[0]}
    return langs, scores, spans


RESULT = "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string, score: double>>"


def label_languages(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score and spans (code points, end exclusive) of each document."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*model.langs], pa.string())
        for batch in batches:
            langs, scores, spans = label_batch(list(texts_of(batch.column(1))), model, switch)
            ends = np.cumsum(np.bincount(spans["row"].astype(np.int64), minlength=batch.num_rows))
            fields = [
                pa.array(spans["start"], pa.int64()),
                pa.array(spans["end"], pa.int64()),
                names.take(pa.array(spans["lang"].astype(np.int64))),
                pa.array(spans["score"].astype(float), pa.float64()),
            ]
            listed = pa.ListArray.from_arrays(
                pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays(fields, ["start", "end", "lang", "score"])
            )
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores), listed]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(label, RESULT)
