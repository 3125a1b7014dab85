"""Quality classifier by Bradley-Terry pairwise ranking.

Documents are described by a few figures of their text. From preference pairs
(a good document against a bad one) a weight per figure is learned by logistic
loss on the difference of the pair's figures. The weighted figures rank all
documents; a quantile of the labelled documents' ranking values is the
threshold, and the score is logistic around it.

Defined results: a null text is an empty one and gets a score like any text.
Labels without doc_id or quality, or with both qualities for one id, are
left out; repeated ones count once. Without labels of both kinds nothing can
be learned: every score is the threshold's and every document is accepted.
Repeated rows get equal scores. An empty table gives no rows. Other columns are
carried along by `score` and the model never sees them.

Only the fit is bounded: it takes the figures of at most `per_class` labelled
documents of each kind, chosen by hash. The threshold is found over all
labelled documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jornada.llm.words import stored

PER_CLASS = 3000
PAIRS_EACH = 20
FOLDS, HELD_OUT = 5, 0
ACCEPT_FROM = 0.3
LEVELS = 1000

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = True
_FIGURES = 15


def figures(text: str | None) -> np.ndarray:
    """What the model sees of a text: shares and logarithms, all of them 0 for an empty text."""
    found = np.zeros(_FIGURES)
    data = (text or "").encode()
    words = data.split()
    if not words:
        return found
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    wide = count[128:].sum()
    n = len(words)
    seen = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = count[_SYMBOLS].sum()
    ends = sum(w[-1] in b"!#$%&*|" for w in words)
    found[:] = (
        upper / max(1, upper + lower),
        min(1.0, 4 * upper / max(1, upper + lower + wide)),
        symbols / len(data),
        min(1.0, 10 * symbols / len(data)),
        ends / n,
        min(1.0, 4 * ends / n),
        count[124] / n,
        again / n,
        min(1.0, 4 * again / n),
        len(seen) / n,
        seen.most_common(1)[0][1] / n,
        count[48:58].sum() / len(data),
        1 - len(set(lines)) / len(lines),
        np.log1p(len(data) / n) / 3,
        np.log1p(n) / 10,
    )
    return found


@dataclass(frozen=True)
class Model:
    """Weights of the standardised figures, and the threshold of the ranking value."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0

    def value(self, table: np.ndarray) -> np.ndarray:
        return np.clip((table - self.centre) / self.scale, -8, 8) @ self.weights


def fit(good: np.ndarray, bad: np.ndarray, pairs_each: int = PAIRS_EACH, penalty: float = 1e-3) -> Model:
    """Weights that rank the good above the bad: Newton's method on the logistic loss of pair differences."""
    both = np.vstack([good, bad])
    if not len(good) or not len(bad):
        return Model(np.zeros(_FIGURES), np.ones(_FIGURES), np.zeros(_FIGURES))
    centre, scale = both.mean(0), np.maximum(both.std(0), 1e-3)
    good, bad = (np.clip((x - centre) / scale, -8, 8) for x in (good, bad))
    random = np.random.default_rng(1)
    pairs = pairs_each * max(len(good), len(bad))
    differences = good[random.integers(len(good), size=pairs)] - bad[random.integers(len(bad), size=pairs)]
    weights = np.zeros(_FIGURES)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(differences @ weights, -30, 30)))
        slope = differences.T @ (p - 1) / pairs + penalty * weights
        curve = (differences * (p * (1 - p))[:, None]).T @ differences / pairs + penalty * np.eye(_FIGURES)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return Model(centre, scale, weights)


def figures_of(docs: DataFrame) -> DataFrame:
    """doc_id and figures of each document."""

    @F.pandas_udf("array<double>")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series([figures(t) for t in text], dtype=object)

    return docs.select("doc_id", of("text").alias("figures"))


def value_of(model: Model) -> Column:
    """The ranking value of the column `text`."""

    @F.pandas_udf("double")
    def of(text: pd.Series) -> pd.Series:
        table = np.array([figures(t) for t in text]).reshape(-1, _FIGURES)
        return pd.Series(model.value(table))

    return of("text")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the row's label must not be learned from; a null id has no label."""
    fold = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def usable_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document that may be learned from: doc_id, quality."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    return known.filter(F.col("quality") == F.col("other")).drop("other")


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fits the weights to a bounded sample of labelled documents, chosen by hash."""
    known = usable_labels(labels)
    picked = None
    for quality in (0, 1):
        of_kind = known.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = of_kind if picked is None else picked.union(of_kind)
    # At most 2 * per_class rows of two numbers.
    sample = figures_of(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"))
    rows = sample.join(F.broadcast(picked), "doc_id").orderBy("doc_id").collect()
    table = {q: np.array([r["figures"] for r in rows if r["quality"] == q]).reshape(-1, _FIGURES) for q in (0, 1)}
    return fit(table[1], table[0])


def best_threshold(good: list[float], bad: list[float], n_good: int, n_bad: int) -> float:
    """The quantile of the labelled ranking values that misjudges fewest labelled documents.

    `good` and `bad` hold the quantiles of each kind at even levels; where a
    whole range of values is equally good, its middle counts.
    """
    levels = np.linspace(0, 1, len(good))
    at = np.unique(np.concatenate([good, bad]))
    middles = (at[1:] + at[:-1]) / 2 if len(at) > 1 else at

    def below(values: list[float], t: np.ndarray) -> np.ndarray:
        x, last = np.unique(values[::-1], return_index=True)
        return np.interp(t, x, levels[len(levels) - 1 - last], left=0.0, right=1.0)

    # Each kind weighs alike, whatever share of the labels it has.
    wrong = below(good, middles) + 1 - below(bad, middles)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    widest = best[np.argmax((at[1:] - at[:-1])[best])] if len(at) > 1 else 0
    return float(middles[widest])


def calibrate(values: DataFrame, labels: DataFrame, model: Model, levels: int = LEVELS) -> Model:
    """The model with its threshold, over all labelled documents that may be learned from.

    `values` has doc_id and value of all documents. Two rows of quantiles, one
    per kind, come to the driver.
    """
    known = values.join(usable_labels(labels), "doc_id")
    at = F.expr(f"array({','.join(repr(i / levels) for i in range(levels + 1))})")
    found = known.groupBy("quality").agg(F.percentile_approx("value", at, 100 * levels).alias("at"), F.count("*").alias("n"))
    rows = {r["quality"]: r for r in found.collect()}
    if len(rows) < 2:
        return Model(model.centre, model.scale, np.zeros(_FIGURES), 0.0)
    threshold = best_threshold(rows[1]["at"], rows[0]["at"], rows[1]["n"], rows[0]["n"])
    return Model(model.centre, model.scale, model.weights, threshold)


def score_of(value: Column, model: Model, accept_from: float = ACCEPT_FROM) -> Column:
    """The ranking value on a scale from 0 to 1 on which the threshold is `accept_from`."""
    at = float(np.log(accept_from / (1 - accept_from)))
    if not model.weights.any():
        return F.lit(accept_from)
    return 1 / (1 + F.exp(-(value - model.threshold + at)))


def ranked(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """The ranking values of all documents (doc_id, value), and the model."""
    model = learn(docs, labels)
    values = stored(docs.select(F.col("doc_id").cast("long"), value_of(model).alias("value")))
    return values, calibrate(values, labels, model)


def score(docs: DataFrame, labels: DataFrame, accept_from: float = ACCEPT_FROM) -> DataFrame:
    """The documents with all their columns and `score`; no document moves."""
    _, model = ranked(docs, labels)
    return docs.withColumn("score", score_of(value_of(model), model, accept_from))
