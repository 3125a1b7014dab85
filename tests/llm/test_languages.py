"""Language identification: held-out accuracy, spans, and Viterbi against all paths."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus
from jornada.llm import languages
from jornada.llm.inputs import documents

TEXTS = {
    "en": "the weather was fine and the children went out to the garden with their friends",
    "de": "das Wetter war schön und die Kinder gingen mit ihren Freunden hinaus in den Garten",
    "el": "ο καιρός ήταν καλός και τα παιδιά βγήκαν στον κήπο με τους φίλους τους",
    "ru": "погода была хорошая и дети вышли в сад со своими друзьями",
    "bg": "времето беше хубаво и децата излязоха в градината със своите приятели",
    "zh": "天气很好孩子们和朋友们一起到花园里去了",
    "ja": "天気がよかったので子どもたちは友だちと庭に出ました",
    "hi": "मौसम अच्छा था और बच्चे अपने दोस्तों के साथ बगीचे में गए",
}


def learnt_id(start):
    return next(i for i in itertools.count(start) if zlib.crc32(str(i).encode()) % 4 != 2)


@pytest.fixture(scope="module")
def model(spark):
    ids, at = [], 0
    for _ in range(12 * len(TEXTS)):
        at = learnt_id(at + 1)
        ids.append(at)
    rows = [(i, text, lang) for i, (lang, text) in zip(ids, list(TEXTS.items()) * 12)]
    return languages.learn(corpus.frame(spark, rows).withColumn("lang", F.col("source")))


def labels(model, *texts, switch=languages.SWITCH):
    langs, scores, spans = languages.label_batch(list(texts), model, switch)
    listed = [[] for _ in texts]
    for row, start, end, lang in zip(spans["row"], spans["start"], spans["end"], spans["lang"]):
        listed[row].append((texts[row][start:end], model.langs[lang]))
    return langs, scores, listed


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = languages.label_languages(docs, languages.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    unseen = found.where(languages.held_out()).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert unseen[1] > 200 and unseen[0] > 0.99
    assert found.where("score < 0 or score > 1 or score is null").isEmpty()


def test_scripts_narrow_the_candidates(model):
    assert model.langs == tuple(sorted(TEXTS))
    langs, scores, _ = labels(model, *[t + "." for t in TEXTS.values()])
    assert langs == list(TEXTS) and (scores > 0.9).all()
    cyrillic = model.uses[list(languages.SCRIPTS).index("cyrillic") + 1]
    assert {lang for lang, used in zip(model.langs, cyrillic) if used} == {"ru", "bg"}


def test_spans_of_mixed_text(model):
    mixed = f"{TEXTS['en']}. {TEXTS['de']}! 12 {TEXTS['ru']} – {TEXTS['en']}"
    assert labels(model, mixed)[2] == [[(TEXTS[x], x) for x in ("en", "de", "ru", "en")]]
    # Without a blank between them, and by one who may not switch.
    assert [x for _, x in labels(model, TEXTS["el"] + TEXTS["ru"])[2][0]] == ["el", "ru"]
    assert len(labels(model, f"{TEXTS['en']} {TEXTS['de']}", switch=1e9)[2][0]) == 1


def test_places_count_code_points(model):
    text = "🙂🙂 İ " + TEXTS["de"] + " 🙂"
    [[(first, lang)]] = labels(model, text)[2]
    assert lang == "de" and first.endswith(TEXTS["de"])


def test_no_letters(model):
    langs, scores, spans = labels(model, "", "123 .,! 🙂", "\n\t")
    assert langs == ["und"] * 3 and not scores.any() and spans == [[], [], []]


def test_unknown_script_gets_a_learned_language(model):
    langs, scores, _ = labels(model, "שלום עולם")
    assert langs[0] in model.langs and 0 < scores[0] <= 1


def test_viterbi_equals_all_paths():
    random = np.random.default_rng(4)
    counts = np.array([3, 0, 6, 1, 5])
    scores = random.normal(size=(counts.sum(), 3)) * 3
    path = languages.best_path(scores, counts, 2.0)
    at = 0
    for n in counts:
        own = scores[at : at + n]

        def value(labels):
            return sum(own[i, x] for i, x in enumerate(labels)) - 2.0 * sum(a != b for a, b in zip(labels, labels[1:]))

        best = max((value(x) for x in itertools.product(range(3), repeat=int(n))), default=0)
        assert value(path[at : at + n]) == pytest.approx(best)
        at += n


def test_pieces_give_the_same(model, monkeypatch):
    texts = [" ".join([t] * 40) for t in TEXTS.values()] + ["", f"{TEXTS['en']} {TEXTS['de']} " * 30]
    whole = labels(model, *texts)
    monkeypatch.setattr(languages, "CELLS", 1)
    monkeypatch.setattr(languages, "WORDS", 100)
    cut = labels(model, *texts)
    assert whole[0] == cut[0] and whole[2] == cut[2] and np.allclose(whole[1], cut[1])


def test_awkward_documents(spark, docs, none):
    learned = languages.learn(docs)
    assert learned.langs == ("xx",)
    found = languages.label_languages(docs, learned).collect()
    assert len(found) == docs.count()
    by_text = {r["doc_id"]: r for r in found}
    assert [by_text[i]["lang_pred"] for i in (1, 2, 3, 4, 14)] == ["und", "und", "und", "xx", "xx"]
    # Nothing to learn from: no rows, or none with a language.
    for empty in (none, docs.withColumn("lang", F.lit(None).cast("string")), docs.where("text is null")):
        nothing = languages.learn(empty)
        assert nothing.langs == ()
        assert {r["lang_pred"] for r in languages.label_languages(docs, nothing).collect()} == {"und"}
    assert languages.label_languages(none, learned).collect() == []


def test_held_out_rows_and_labels_are_not_used(spark):
    ids = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 4 == 2][:20]
    rows = [(i, TEXTS["en"], "en") for i in ids] + [(None, TEXTS["de"], "de")]
    assert languages.learn(corpus.frame(spark, rows).withColumn("lang", F.col("source"))).langs == ()
