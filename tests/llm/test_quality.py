import corpus
import numpy as np
from pyspark.sql import functions as F

from jornada.llm import quality


def labelled(spark):
    rows, labels = [], []
    for i in range(300):
        text = corpus.sentence(40 + i % 50, i)
        if i % 5 == 0:
            text = [text.upper().replace(" ", "!! "), "word " * 60, text.replace(" ", " | "), text.replace(" ", "### ")][i // 5 % 4]
        rows.append((i, text, "s"))
        labels.append((i, int(i % 5 != 0)))
    return corpus.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled(spark)
    scored = quality.score(docs, labels).select("doc_id", "score", quality.held_out().alias("out")).collect()
    out = [r for r in scored if r["out"]]
    assert len(scored) == 300 and len(out) > 30
    assert np.mean([(r["score"] >= quality.ACCEPT_FROM) == (r["doc_id"] % 5 != 0) for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in scored)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = labelled(spark)
    wrong = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (
        {r[0]: r[1] for r in quality.score(docs, x).select("doc_id", "score").collect()} for x in (labels, wrong)
    )
    assert a == b


def test_awkward_rows_and_labels(spark, docs, none):
    _, labels = labelled(spark)
    odd = labels.union(spark.createDataFrame([(None, 1), (3, None), (4, 7), (6, 0), (6, 1), (8, 1), (8, 1)], labels.schema))
    scored = quality.score(docs, odd)
    assert scored.count() == docs.count() and set(scored.columns) == set(docs.columns)
    assert scored.filter(F.col("score").isNull() | F.isnan("score")).count() == 0
    known = {r[0] for r in quality.usable_labels(odd).collect()}
    assert 6 not in known and 8 in known | {8}
    assert quality.score(none, odd).count() == 0


def test_without_labels_every_document_is_accepted(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(docs, empty).filter(F.col("score") < quality.ACCEPT_FROM).count() == 0
    one_kind = spark.createDataFrame([(8, 1), (9, 1)], "doc_id long, quality int")
    assert quality.score(docs, one_kind).filter(F.col("score") < quality.ACCEPT_FROM).count() == 0


def test_pairwise_fit_ranks_better_documents_higher():
    random = np.random.default_rng(0)
    good, bad = random.normal(0.5, 1, (400, 15)), random.normal(-0.5, 1, (100, 15))
    model = quality.fit(good, bad)
    assert np.mean(model.value(good)[:, None] > model.value(bad)[None, :]) > 0.95


def test_threshold_lies_in_the_widest_gap():
    assert quality.best_threshold([5.0, 6.0, 7.0], [1.0, 2.0, 3.0], 3, 3) == 4.0


def test_figures_of_extreme_texts():
    assert not quality.figures(None).any() and not quality.figures("").any() and not quality.figures(" \n").any()
    for text in ("!", "A", "é", "a" * 100_000, "\x00"):
        assert np.isfinite(quality.figures(text)).all()


def test_fit_equals_plain_descent():
    """The same loss over the same pairs, brought down by plain gradient steps."""
    random = np.random.default_rng(2)
    good, bad = random.normal(0.3, 1, (60, 15)), random.normal(-0.3, 1, (40, 15))
    model = quality.fit(good, bad, pairs_each=5, penalty=0.05)
    both = np.vstack([good, bad])
    centre, scale = both.mean(0), both.std(0)
    draw = np.random.default_rng(1)
    pairs = 5 * 60
    first = np.clip((good - centre) / scale, -8, 8)[draw.integers(60, size=pairs)]
    second = np.clip((bad - centre) / scale, -8, 8)[draw.integers(40, size=pairs)]
    weights = np.zeros(15)
    for _ in range(20_000):
        wrong = 1 / (1 + np.exp((first - second) @ weights))
        weights -= 0.05 * (0.05 * weights - (first - second).T @ wrong / pairs)
    assert np.allclose(weights, model.weights, atol=1e-4)


def test_scores_equal_a_plain_version(spark):
    docs, labels = labelled(spark)
    model = quality.learn(docs, labels)
    _, found = quality.ranked(docs, labels)
    assert np.allclose(found.weights, model.weights)
    for row in quality.score(docs, labels).select("text", "score").collect():
        shown = np.clip((quality.figures(row["text"]) - model.centre) / model.scale, -8, 8)
        value = sum(a * b for a, b in zip(shown, model.weights))
        # The threshold has the score from which documents are accepted.
        odds = np.exp(value - found.threshold) * quality.ACCEPT_FROM / (1 - quality.ACCEPT_FROM)
        assert abs(row["score"] - odds / (1 + odds)) < 1e-9


def test_threshold_misjudges_fewest_labelled_documents(spark):
    docs, labels = labelled(spark)
    values, model = quality.ranked(docs, labels)
    known = values.join(quality.usable_labels(labels), "doc_id").collect()
    good, bad = ([r["value"] for r in known if r["quality"] == q] for q in (1, 0))

    def wrong(at):
        return np.mean(np.array(good) < at) + np.mean(np.array(bad) >= at)

    assert wrong(model.threshold) <= min(wrong(at) for at in good + bad) + 0.01
