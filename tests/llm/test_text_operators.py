"""Line dedup, mixing, packing, personal data, language-model scoring and exact dedup against plain versions."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from jornada.llm import attention, exact_dedup, line_dedup, lm_scoring, mixing, packing, pii
from jornada.llm.words import stored

BLANKS = " \t\n\x0b\x0c\r"


def told(rows):
    return sorted(rows, key=str)


# Line dedup


def plain_lines(rows, least_chars=10, least_docs=2):
    holders = collections.defaultdict(set)
    last = 1 << 62
    key = lambda line: line.strip(BLANKS).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(last if i is None else i)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        gone = [
            len(key(x)) >= least_chars and len(holders[key(x)]) >= least_docs and min(holders[key(x)]) < (last if i is None else i)
            for x in lines
        ]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return out


@pytest.mark.parametrize("least_docs", [2, 3])
def test_lines_equal_a_plain_version(docs, least_docs):
    got = line_dedup.dedup_lines(docs, least_docs=least_docs)
    assert set(docs.columns) <= set(got.columns)
    rows = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
    assert told(rows) == told(plain_lines(corpus.texts(), least_docs=least_docs))


def test_rows_of_one_holder_keep_their_lost_lines_apart(spark):
    """Many rows without an id, or with the same one: what a row loses never exceeds its own lines."""
    lines = [corpus.sentence(5, 800 + i) for i in range(60)]
    rows = [(1, "\n".join(lines), "s")]
    rows += [(i, "\n".join(lines[k : k + 3] + [f"a line of {k} alone"]), "s") for i in (None, 7) for k in range(0, 57)]
    rows += rows[-2:]
    docs = corpus.frame(spark, rows)
    hashes = line_dedup.line_hashes(docs)
    lost = line_dedup.lost_lines(hashes, line_dedup.shared_lines(hashes)).select(F.size("__drop").alias("n")).collect()
    assert max(r["n"] for r in lost) <= 4 and len(lost) == 2 * 57
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(docs).collect()]
    assert told(got) == told(plain_lines(rows))


def test_no_lines(none):
    assert line_dedup.dedup_lines(none).count() == 0


# Mixing


def test_targets_share_the_excess_again():
    assert mixing.targets([10, 100], [5, 2], 1.5, 2) == [20.0, 145.0]
    assert mixing.targets([], [], 1.5, 2) == [] and mixing.targets([0, 4], [5, 2], 1.5, 2) == [0.0, 6.0]
    many = mixing.targets([7, 1000, 50, 3, 90], [5, 2, 1, 5, 2], 1.5, 2)
    assert math.isclose(sum(many), 1.5 * 1150) and all(a <= 2 * s + 1e-9 for a, s in zip(many, [7, 1000, 50, 3, 90]))


def test_mix_meets_each_budget(docs):
    rows = mixing.mix(docs, carry=["doc_id", "source"]).collect()
    assert len(rows) == docs.count()
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    size = collections.Counter()
    for _, text, source in corpus.texts():
        size[source] += len(corpus.words(text))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    aims = mixing.targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)
    for name, aim in zip(names, aims):
        own = by_source[name]
        assert {r["source_size"] for r in own} == {size[name]} and math.isclose(own[0]["target"], aim)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - aim) <= 2
        partial = [r for r in own if r["size"] and r["taken"] % r["size"]]
        assert len(partial) <= 2


def test_mix_is_repeatable_and_draws_what_it_takes(docs, none):
    a, b = (told(map(tuple, mixing.mix(docs.repartition(n), carry=["doc_id"]).collect())) for n in (2, 7))
    assert a == b
    mixed = mixing.mix(docs)
    assert set(docs.columns) - {"size"} <= set(mixed.columns)
    taken = {r[0]: r[1] for r in mixed.filter("size > 0").groupBy("source").agg(F.sum("taken")).collect()}
    drawn = mixing.draw(mixed, ["doc_id", "text", "source"])
    words = collections.Counter()
    for r in drawn.collect():
        words[r["source"]] += len(corpus.words(r["text"]))
    # A source without words is drawn from, but takes none.
    assert {k: n for k, n in words.items() if n} == taken
    assert mixing.mix(none).count() == 0


def test_a_cut_document_keeps_its_first_words(spark):
    docs = corpus.frame(spark, [(i, " a1\tb2\n c3  ", "s") for i in range(5)] + [(9, "x " * 100, "t")])
    mixed = mixing.mix(docs, weights=(1.0, 1.0), share=0.1)
    drawn = mixing.draw(mixed, ["doc_id", "text", "source"]).collect()
    own = [r["text"] for r in drawn if r["source"] == "s"]
    assert sum(len(t.split()) for t in own) == mixed.filter("source = 's'").agg(F.sum("taken")).first()[0]
    assert all(t == " a1\tb2\n c3  " or "a1 b2 c3".startswith(t) for t in own)


# Packing


def test_pieces_hold_every_id_once(docs, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.VOCABULARY)
    expected = told(
        (i, np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t, _ in corpus.texts()
    )
    rows = packing.pack(docs.withColumn("row", F.monotonically_increasing_id())).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["length"] == 1 << r["bucket"] <= 2048 and r["offset"] == 0 and len(r["ids"]) == 4 * r["length"] for r in rows)
    whole, current = [], b""
    for r in sorted(rows, key=lambda r: r["sequence_id"]):
        assert r["start"] * 4 == len(current)
        current += bytes(r["ids"])
        if len(current) == 4 * r["doc_tokens"]:
            whole.append((r["doc_id"], current))
            current = b""
    assert told(whole) == expected
    assert packing.pack(none).count() == 0


def test_cuts_are_binary_digits():
    assert packing.cuts(2048 * 2 + 5) == [(0, 2048), (2048, 2048), (4096, 4), (4100, 1)]
    assert packing.cuts(1) == [(0, 1)] and packing.cuts(0) == []
    with pytest.raises(ValueError):
        packing.pack(None, longest=1000)


def test_fast_ids_equal_the_exact_ones():
    fast, exact = packing.encoder(packing.VOCABULARY, packing.RANKS), packing.encoder(packing.VOCABULARY, None)
    own = random.Random(1)
    letters = "ab é ü\t\n  'sAZ09.,!?-" + " ​中🙂ßſ\u0085\x1c\x0b"
    for _ in range(400):
        text = "".join(own.choice(letters) for _ in range(own.randint(0, 60)))
        assert fast(text) == exact(text), repr(text)
    for text in (" " * 3000 + "x", "a" * 20_000, "<|endoftext|>", "x\n\n\n  y"):
        assert fast(text) == exact(text)


# Personal data


def plain_spans(text):
    out = []
    for kind, pattern, good in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if good(m.group())]
    return out


def test_plain_spans_equal_the_patterns():
    own = random.Random(2)
    for _ in range(4000):
        text = "".join(own.choice(["a.b", "@", ".", "-", "+", "1", "25", "4111", " ", "é", "(", ")", "x", "_", "0"]) for _ in range(own.randint(0, 30)))
        assert pii.plain_spans(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("write to jane [at] mail [dot] com now", "email", "jane [at] mail [dot] com"),
        ("jane(at)mail(dot)org", "email", "jane(at)mail(dot)org"),
        ("mail john dot doe at example dot com today", "email", "john dot doe at example dot com"),
        ("jоhn@example.com", "email", "jоhn@example.com"),
        ("see jane＠mail．com", "email", "jane＠mail．com"),
        ("host one nine two dot one six eight dot one dot one up", "ip", "one nine two dot one six eight dot one dot one"),
        ("card four one one one 1111 1111 one one one one", "card", "four one one one 1111 1111 one one one one"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("call plus four four two zero seven nine four six", "phone", "plus four four two zero seven nine four six"),
        ("call +1 (555​) 010-99​99 now", "phone", "+1 (555​) 010-99​99"),
    ],
)
def test_disguises_are_found_in_place(text, kind, found):
    spans = [text[s:e] for k, s, e, _ in pii.find(text) if k == kind]
    assert found in spans


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("host 192 dot 168 dot 1 dot 1 up", "ip", "192 dot 168 dot 1 dot 1"),
        ("in 2020 10 192 punto 168 punto 1 punto 1 up", "ip", "192 punto 168 punto 1 punto 1"),
        ("card 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
        ("call +44 20 7946 095 eight", "phone", "+44 20 7946 095 eight"),
        ("write jane at mail.com now", "email", "jane at mail.com"),
        ("write jane.roe at mail.co.uk.", "email", "jane.roe at mail.co.uk"),
        ("an jane at mail punkt de bitte", "email", "jane at mail punkt de"),
        ("a juana arroba correo punto es hoy", "email", "juana arroba correo punto es"),
        ("à jeanne arobase courrier point fr svp", "email", "jeanne arobase courrier point fr"),
        ("Karte vier eins eins eins 1111 1111 1111 eins eins eins eins", "card", None),
        ("Karte vier eins eins eins 1111 1111 eins eins eins eins", "card", "vier eins eins eins 1111 1111 eins eins eins eins"),
        ("carte quatre un un un 1111 1111 un un un un", "card", "quatre un un un 1111 1111 un un un un"),
        ("tarjeta cuatro uno uno uno 1111 1111 uno uno uno uno", "card", "cuatro uno uno uno 1111 1111 uno uno uno uno"),
        ("más tres cuatro cinco fünf sechs siete ocho neuf", "phone", "más tres cuatro cinco fünf sechs siete ocho neuf"),
        ("a dot b dot c dot d dot e dot f dot g dot h dot i at m dot n dot o dot p dot q dot r dot s dot t dot com", "email",
         "a dot b dot c dot d dot e dot f dot g dot h dot i at m dot n dot o dot p dot q dot r dot s dot t dot com"),
    ],
)
def test_disguises_that_gates_kept_back(text, kind, found):
    spans = [text[s:e] for k, s, e, _ in pii.find(text) if k == kind]
    assert spans == [] if found is None else found in spans


def test_words_of_the_language_are_no_addresses():
    for text in ("Look at this point in time.", "We looked at home.Then we left.", "He is at no point in doubt, at 3 point 5.", "Un dos."):
        assert pii.find(text) == [], pii.find(text)
    for text in ("a dot " * 50_000 + "at b", "x at y dot " * 30_000, "1 dot " * 50_000, "at b.c " * 30_000):
        pii.find(text)


def test_ordinary_prose_is_left_alone():
    for text in (
        "We met at noon. Dot the i at home, one two three go.",
        "The one at the top is of no use to anyone of us at all.",
        corpus.sentence(2000, 40),
        "Версия текста без данных",
    ):
        assert pii.find(text) == [], pii.find(text)
    assert pii.find(None) == pii.find("") == []


def test_long_runs_cost_no_more_than_their_length():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 100_000, "one " * 50_000):
        pii.find(text)


@pytest.mark.parametrize(
    "text",
    [" " * 1_000_000, "\t" * 1_000_000, "( " * 500_000, "(" + " " * 1_000_000, "(at " * 250_000, "a-at-" * 200_000, "@a" * 500_000,
     "&#" + "0" * 1_000_000, "lO." * 333_000, "+1" + " " * 1_000_000, "0" * 1_000_000],
)
def test_a_megabyte_takes_about_a_second(text):
    start = time.process_time()
    assert pii.find(text) == []
    assert time.process_time() - start < 3


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("mail john(a)example.com now", "email", "john(a)example.com"),
        ("mail john&#64;mail&#46;example.org now", "email", "john&#64;mail&#46;example.org"),
        ("mail john&commat;mail.example.org now", "email", "john&commat;mail.example.org"),
        ("jane [ at ]   mail  (dot) com", "email", "jane [ at ]   mail  (dot) com"),
        ("host 192.l68.O.1 up", "ip", "192.l68.O.1"),
        ("card 4111 l111 1111 1111.", "card", "4111 l111 1111 1111"),
        ("call +4O 2O 7946 0958", "phone", "+4O 2O 7946 0958"),
        ("at " + "0" * 60 + "1.2.3.4 now", "ip", "0" * 60 + "1.2.3.4"),
    ],
)
def test_more_disguises(text, kind, found):
    assert found in [text[s:e] for k, s, e, _ in pii.find(text) if k == kind]


def test_what_is_no_disguise():
    for text in ("See (a) e.g. this one.", "Ol.Il.lo.oo and Il.lO.oo.ll", "hello (a) b", "point (a) of 3.4 and (b)"):
        assert pii.find(text) == [], pii.find(text)


def test_spans_of_documents(spark, docs, none):
    rows = pii.find_pii(docs).collect()
    assert len(rows) == docs.count() and pii.find_pii(none).count() == 0
    one = pii.find_pii(corpus.frame(spark, [(1, "é a@b.co 🙂 +1 555 010 9999", "s")])).first()["spans"]
    assert [(s["kind"], s["start"], s["end"], s["value"]) for s in one] == [("email", 2, 8, "a@b.co"), ("phone", 11, 26, "+1 555 010 9999")]


# Language-model scoring


def test_baseline_and_scores(docs, none, monkeypatch):
    rows = lm_scoring.score_texts(docs, steps=60, common_words=50).collect()
    assert len(rows) == docs.count()
    counts = collections.Counter()
    for i, t, _ in corpus.texts():
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*corpus.words(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    expected = told(
        (i, len(w) + 1, sum(counts[x] > 0 for x in [*w, b"\n"]), round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, b"\n"]), 4))
        for i, w in ((i, corpus.words(t)) for i, t, _ in corpus.texts())
    )
    assert told((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == expected
    assert {r["train_tokens"] for r in rows} == {n}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm_scoring.score_texts(none, steps=5).count() == 0


def test_model_scores_each_id_once_in_its_window():
    random_ = np.random.default_rng(0)
    counts = random_.integers(0, 50, 300).astype(np.int64)
    words = attention.vocabulary(counts, random_.integers(0, 2, 300))
    shares = np.bincount(words.classes, np.exp(words.share))
    assert np.allclose(shares[shares > 0], 1)
    windows = random_.integers(0, 300, (200, attention.WINDOW + 1))
    model = attention.train(words, windows, steps=30)
    scorer = attention.Scorer(model)
    texts = [random_.integers(0, 300, n).astype(np.int32) for n in (1, 15, 16, 17, 70)]
    together = attention.score(scorer, words, texts, 0, at_once=2)
    alone = np.concatenate([attention.score(scorer, words, [t], 0) for t in texts])
    assert np.allclose(together, alone, rtol=1e-4)
    # A plain version: every id from the exact part of the text that its window shows.
    for text, found in zip(texts, together):
        total = 0.0
        given = np.concatenate([[0], text])
        for i, wanted in enumerate(text):
            begin = max(0, i // attention.STRIDE * attention.STRIDE - attention.STRIDE)
            seen = words.inputs[given[begin : i + 1]][None, :]
            flat = attention._with_one(attention._attend(model, seen)[-1])[-1:]
            flat[:, : attention.WIDTH] += np.maximum(flat @ model.dense, 0) @ model.back
            group, slot = divmod(int(words.classes[wanted]), attention.SLOTS)
            total += np.log(attention._softmax(flat @ model.groups)[0, group])
            total += np.log(attention._softmax(flat @ model.slots[group])[0, slot]) + words.share[wanted]
        assert math.isclose(total / math.log(10), found, rel_tol=1e-3)


def test_training_follows_the_slope():
    words = attention.vocabulary(np.arange(100), np.zeros(100, np.int64))
    windows = np.tile(np.arange(attention.WINDOW + 1) % 7, (64, 1))
    model = attention.train(words, windows, steps=200)
    scorer = attention.Scorer(model)
    text = (np.arange(1, 33) % 7).astype(np.int32)
    assert attention.score(scorer, words, [text], 0)[0] > 0.5 * len(text) * math.log10(1 / 7)


def test_model_learns_from_all_training_texts(spark, monkeypatch):
    """Every window of every text is learned from once, in tasks of several rounds, however many there are."""
    monkeypatch.setattr(lm_scoring, "LEAST_WINDOWS", 1)
    monkeypatch.setattr(lm_scoring, "ROUNDS", 2)
    texts = [(i, corpus.sentence(60 + i, 700 + i), "s") for i in range(40)]
    docs = corpus.frame(spark, texts)
    encoding, opens = lm_scoring.subwords(packing.RANKS)
    ids = [lm_scoring.ids_of(encoding, corpus.words(t)) for _, t, _ in texts]
    counts = np.bincount(np.concatenate(ids), minlength=lm_scoring.IDS)
    vocabulary = attention.vocabulary(counts, opens)
    start, seen, tasks = attention.Attention.new(), 0, set()
    for turn in range(2):
        own = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == turn)
        rows = lm_scoring.learned(own, start, vocabulary, packing.RANKS, 0, 0.01).orderBy("piece").collect()
        for task in {r["task"] for r in rows}:
            counts_of = np.concatenate([np.frombuffer(r["counts"], np.float32) for r in rows if r["task"] == task])
            # The distances' weights count every position.
            seen += counts_of[start.table.size]
            tasks.add((turn, task))
    assert seen == sum(map(len, ids)) and len(tasks) > 2
    model = lm_scoring.fitted(docs, vocabulary, packing.RANKS, int(counts.sum()))
    before, after = (attention.score(attention.Scorer(m), vocabulary, ids, lm_scoring.END_ID).sum() for m in (start, model))
    assert after > 0.9 * before
    known = np.append(np.unique(vocabulary.inputs[np.concatenate(ids)]), vocabulary.inputs[lm_scoring.END_ID])
    never = np.setdiff1d(np.arange(attention.INPUTS), known)
    assert np.allclose(model.table[never], start.table[never])


# Exact dedup


def plain_copies(rows):
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    return groups


def test_copies_equal_a_plain_version(spark, docs):
    rows = exact_dedup.dedup(docs, exact_dedup.scratch_index(spark)).collect()
    groups = plain_copies(corpus.texts())
    assert len(rows) == docs.count()
    for r in rows:
        own = groups[bytes(r["digest"]).hex()]
        known = [i for i in own if i is not None]
        assert r["group_size"] == len(own) and r["keep_id"] == (min(known) if known else None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in rows) == len(groups)


def test_index_remembers_earlier_batches(spark, docs, none):
    folder = exact_dedup.scratch_index(spark).folder
    first = docs.filter("doc_id < 100")
    exact_dedup.dedup(first, exact_dedup.DigestIndex(spark, folder)).count()
    # Opened anew, as another session would.
    index = exact_dedup.DigestIndex(spark, folder)
    again = exact_dedup.dedup(first, index).collect()
    assert not any(r["kept"] for r in again)
    rest = exact_dedup.dedup(docs, index).collect()
    old = set(plain_copies([r for r in corpus.texts() if r[0] is not None and r[0] < 100]))
    assert sum(r["kept"] for r in rest) == len(set(plain_copies(corpus.texts())) - old)
    assert index.table().count() == len(plain_copies(corpus.texts())) == index.table().select("digest").distinct().count()
    assert exact_dedup.dedup(none, index).count() == 0


def test_a_closed_index_leaves_its_files(spark, docs):
    index = exact_dedup.scratch_index(spark)
    found = exact_dedup.dedup(docs, index)
    index.close()
    assert not spark.catalog.tableExists(index.name) and found.count() == docs.count()
    again = exact_dedup.DigestIndex(spark, index.folder)
    assert again.table().count() == len(plain_copies(corpus.texts()))
    again.close()


def test_a_word_has_its_ids_whether_held_or_not(monkeypatch):
    """Words together, one by one, and in a full table of words give the tokenizer's ids."""
    encoding, _ = lm_scoring.subwords(packing.RANKS)
    odd = ["\u00a0", "a\u00a0", "\u00a0b", "x'", "'s", "5G", "\u4e2d\u6587", "caf\u00e9", "\U0001f642\U0001f642", "w" * 200, "--", "\u2003z"]
    own = corpus.words(" ".join([*odd, corpus.sentence(30, 5), *odd[::-1]]))
    whole = encoding.encoding.encode_ordinary(" " + b" ".join(own).decode())
    monkeypatch.setattr(lm_scoring, "_WORDS_HELD", 3)
    for held in (encoding, lm_scoring.Subwords(encoding.encoding)):
        assert lm_scoring.ids_of(held, own).tolist() == [*whole, lm_scoring.END_ID]
    assert lm_scoring.ids_of(encoding, []).tolist() == [lm_scoring.END_ID]


def test_steps_grow_with_what_was_learned():
    sizes = [attention.batch_after(n) for n in (0, 1600, 5000, 12_800, 1e9)]
    assert sizes == [16, 16, 50, 128, 128]


def test_a_new_model_begins_at_the_frequencies():
    """Before any step, a class is about as likely as it is frequent, and the classes' probabilities add up to one."""
    counts = np.arange(2000)[::-1].astype(np.int64) ** 2
    words = attention.vocabulary(counts, np.arange(2000) % 2)
    model = attention.Attention.at_frequencies(words)
    of_group, of_slot = np.exp(model.groups[-1]), np.exp(model.slots[:, -1])
    assert np.isclose(of_group.sum(), 1) and np.allclose(of_slot.sum(1), 1)
    frequent = int(words.classes[0])
    assert np.isclose(of_group[frequent // attention.SLOTS] * of_slot.ravel()[frequent], counts[0] / counts.sum(), rtol=0.01)


def test_stored_ids_are_learned_from_and_scored_as_their_texts(spark, monkeypatch):
    """Texts are encoded once: rounds and scores need the stored ids alone, and give what the texts give."""
    monkeypatch.setattr(lm_scoring, "LEAST_WINDOWS", 1)
    monkeypatch.setattr(lm_scoring, "ROUNDS", 2)
    texts = [(i, corpus.sentence(40 + i, 300 + i), "s") for i in range(20)] + [(None, None, "s"), (21, "", "s"), (21, "Café   中文", None)]
    # As a table: of rows in the plan, a filter would make other partitions.
    docs = stored(corpus.frame(spark, texts).withColumn("held_out", F.lit(False)))
    encoding, opens = lm_scoring.subwords(packing.RANKS)
    ids = [lm_scoring.ids_of(encoding, corpus.words(t)) for _, t, _ in texts]
    held = {w: 9 for w in corpus.words(texts[0][1])}
    coded = lm_scoring.encoded(docs, packing.RANKS, held, False).drop("text")
    rows = coded.collect()
    assert sorted(bytes(r["ids"]) for r in rows) == sorted(x.astype(np.uint16).tobytes() for x in ids)
    assert all(r["n_tokens"] - r["n_known"] == len(r["others"]) and math.isclose(r["known_sum"], r["n_known"]) for r in rows)
    assert any(r["n_known"] for r in rows) and any(r["others"] for r in rows) and {r["turn"] for r in rows} == {0, 1}
    counts = np.bincount(np.concatenate(ids), minlength=lm_scoring.IDS)
    vocabulary = attention.vocabulary(counts, opens)
    plain, model = (lm_scoring.fitted(x, vocabulary, packing.RANKS, int(counts.sum())) for x in (docs, coded))
    assert np.array_equal(attention.flat_of(plain), attention.flat_of(model))
    found = lm_scoring.scored(coded.withColumn("_row", F.monotonically_increasing_id()), model, vocabulary).collect()
    scores = attention.score(attention.Scorer(model), vocabulary, ids, lm_scoring.END_ID)
    assert np.allclose(sorted(r["score"] for r in found), sorted(scores), rtol=1e-4)
