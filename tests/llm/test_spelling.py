"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus
from jornada.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, spelling.spelling_groups(frame).collect()), key=str)


def variants(seed, n_bases, alphabet):
    """Texts of words with every kind of edit at every place, ties, chains, and words that only differ at an end."""
    own = random.Random(seed)
    words = []
    for _ in range(n_bases):
        base = "".join(own.choice(alphabet) for _ in range(own.randint(7, 12)))
        words += [base] * 40
        for _ in range(12):
            i = own.randrange(len(base) + 1)
            edit = own.choice([base[:i] + own.choice(alphabet) + base[i:], base[:i] + base[i + 1 :], base[:i] + own.choice(alphabet) + base[i + 1 :]])
            words += [edit] * own.choice([2, 3, 4, 41])
            j = own.randrange(len(edit))
            words += [edit[:j] + edit[j + 1 :], own.choice(alphabet) + edit] * 2
    own.shuffle(words)
    return [(i, " ".join(words[i::50]), "s") for i in range(50)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyzé×"])
def test_equals_brute_force(spark, alphabet):
    rows = variants(3, 12, alphabet)
    assert got(corpus.frame(spark, rows)) == plain(rows)


def test_large_groups_are_cut(spark, monkeypatch):
    rows = variants(5, 8, "ab")
    words = spelling.words_of(corpus.frame(spark, rows))
    whole = sorted(map(tuple, spelling.near_words(words).collect()))
    assert whole == sorted(map(tuple, spelling.near_words(words, cells=12).collect()))
    known = plain_words(rows)
    assert whole == sorted((a, b, known[b]) for a in known for b in known if one_edit(a, b))


def test_one_prefix_of_a_third_of_all_words(spark):
    own = random.Random(1)
    tails = {"".join(own.choice("abc") for _ in range(6)) for _ in range(300)}
    rows = [(i, f"prefixed{t} prefixed{t}", "hot") for i, t in enumerate(sorted(tails))]
    rows += [(1000 + i, f"{corpus.sentence(6, i)} " * 2, "s") for i in range(100)]
    assert got(corpus.frame(spark, rows)) == plain(rows)


def test_awkward_documents(docs):
    assert got(docs) == plain([(r["doc_id"], r["text"], None) for r in docs.collect()])


def test_long_words(spark):
    long = "abcdefghij" * 3000
    rows = [(i, f"{long} {long[:-1]} {long[:500]}x{long[500:]}", "a") for i in range(3)]
    assert got(corpus.frame(spark, rows)) == plain(rows)


def test_chain_of_forms(spark):
    rows = [(None, " ".join(["chained"] * 2000 + ["chainedx"] * 200 + ["chainedxy"] * 20 + ["chainedxyz"] * 2), "a")]
    found = {r[0]: r[1:3] for r in got(corpus.frame(spark, rows))}
    assert found == {
        "chained": (None, "chained"),
        "chainedx": ("chained", "chained"),
        "chainedxy": ("chainedx", "chained"),
        "chainedxyz": ("chainedxy", "chained"),
    }


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None), (3, "short w0rds 1234567", "a")]])
def test_no_words(spark, rows):
    assert got(corpus.frame(spark, rows)) == []


def test_scan_of_a_list():
    words = sorted(["", "a", "ab", "abc", "b", "ba", "bc", "c", "cab"])
    codes, lengths = spelling._code_rows(words)
    i, j = spelling.near_in_list(codes, lengths, np.full(len(words), len(words)))
    assert sorted((words[a], words[b]) for a, b in zip(i, j)) == [(a, b) for a in words for b in words if a < b and one_edit(a, b)]
