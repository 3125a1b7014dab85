"""Small documents with every awkward case, and plain versions of the operators' rules."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, label string, region string, hash string, holder string, digest string"

_random = random.Random(7)
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def sentence(n: int, seed: int) -> str:
    own = random.Random(seed)
    return " ".join("".join(own.choice(SYLLABLES) for _ in range(own.randint(1, 4))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source) with nulls, empties, copies, near copies, short, long and strange texts."""
    long = sentence(30_000, 1)
    base = sentence(120, 2)
    words = base.split()
    near = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in (3, 60, 110)]
    passage = "This passage stands in many documents of the table."
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\r\n\x0b\x0c ", "a"),
        (4, "one", "b"),
        (5, "One", None),
        (6, "one  two\tthree", "b"),
        (7, "one two three", "b"),
        (8, base, "b"),
        (9, base.upper(), "b"),
        (10, base, None),
        (11, near[0], "c"),
        (12, near[1], "c"),
        (13, near[2], "c"),
        (14, long, "hot"),
        (15, long + " more", "hot"),
        (16, "w" * 50_000, "hot"),
        (17, f"{sentence(20, 3)}\n{passage}\n{sentence(20, 4)}", "hot"),
        (18, f"{passage}\n{sentence(20, 5)}\n  {passage.upper()}\t", "hot"),
        (19, f"{sentence(9, 6)}\n\n\n{passage}", "hot"),
        (20, "ünï cödé   Ünï 中文 текст 🙂 é́", "d"),
        (21, "<|endoftext|> plain", "d"),
        (22, "word\u0085next\x1cafter", "d"),
        (None, base, "d"),
        (None, "nobody knows my number but I have words enough for shingles", None),
        (23, sentence(40, 8), "é"),
        (23, sentence(40, 8), "é"),
        (24, sentence(3, 9), "z"),
        (-5, sentence(50, 10), "z"),
        (1 << 40, base + " tail", "z"),
    ]
    rows += [(100 + i, sentence(80, 11), "hot") for i in range(60)]
    group = sentence(200, 12).split()
    for i in range(70):
        own = list(group)
        own[i * 2] = f"x{i}"
        rows.append((300 + i, " ".join(own), "hot"))
    rows += [(500 + i, sentence(30 + i, 100 + i), f"s{i % 5}") for i in range(60)]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "xx", s, None if t is None else len(t), "clash", "clash", "clash", "c", "c", "c", "c") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None) -> frozenset:
    own = words(text)
    if len(own) >= 5:
        return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    return frozenset([tuple(own)]) if own else frozenset()
