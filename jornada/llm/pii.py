"""Personal data, found through disguises, with the places in the source text.

Plain identifiers are found first. Then a transducer rewrites the text:
homoglyphs and styled letters become ASCII, invisible characters go, runs of
spelled digits become digits, letters among digits become the digits they look
like, and at/dot disguises become "@" and ".". Every character of the rewritten text knows the source characters it stands for, so
identifiers found there are mapped back to source spans. Those spans are added
to the plain ones; plain ones always stay.

Spans are code points, end exclusive, leftmost and non-overlapping per kind.

Digits, "at" and "dot" are known in English, German, French and Spanish. "at"
before a host with plain dots counts if the host's last label is one of usual
hosts; "un" alone among plain digits stays an article.

Defined results: a null or empty text has no spans. A span that a disguise
yields is added only if it holds a rewritten character and is not inside a
plain span of its kind. Rows are independent: repeated rows and null ids give
repeated results. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Goes from host to host and back over the local part, so long words cost no more than their length."""
    end = 0
    for host in _HOST.finditer(text) if "@" in text else ():
        start = host.start()
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < host.start():
            end = host.end()
            yield "email", start, end


def addresses(text: str) -> Iterator[Span]:
    """Takes the numbers of a dotted run four at a time, as a leftmost search does."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, run.start(), run.end())]
        for i in range(0, len(groups) - 3, 4):
            numbers = [text[s:e].lstrip("0") for s, e in groups[i : i + 4]]
            if all(len(x) <= 3 and int(x or 0) <= 255 for x in numbers):
                yield "ip", groups[i][0], groups[i + 3][1]


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield "phone", m.start(), m.end()


def plain_spans(text: str) -> list[Span]:
    """Identifiers as they stand, by kind and then by start."""
    found = list(emails(text))
    if _DIGIT.search(text):
        found += [*addresses(text), *cards(text), *phones(text)]
    return found


# Letters of other scripts that look like the ASCII character they stand for.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "ο": "o", "α": "a", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "χ": "x", "ε": "e", "τ": "t",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ℓ": "l",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "。": ".", "․": ".", "·": ".", "•": ".",
}
#: Characters without width, and soft hyphens.
INVISIBLE = "​‌‍⁠﻿­᠎"
#: Ranges of styled, enclosed, full-width and other digits and letters, folded by Unicode's own tables.
STYLED = ((0xFF01, 0xFF5E), (0x1D400, 0x1D7FF), (0x2070, 0x209C), (0x2460, 0x2468), (0x24B6, 0x24E9), (0xFE50, 0xFE6B),
          (0x2000, 0x200A), (0x00A0, 0x00A0), (0x202F, 0x202F), (0x3000, 0x3000))
OTHER_DIGITS = (0x0660, 0x06F0, 0x0966, 0x09E6)


def _characters() -> dict[str, str]:
    table = dict(LOOKALIKES) | dict.fromkeys(INVISIBLE, "")
    for low, high in STYLED:
        for code in range(low, high + 1):
            folded = unicodedata.normalize("NFKC", chr(code))
            if len(folded) == 1 and folded.isascii():
                table[chr(code)] = folded
    for zero in OTHER_DIGITS:
        table |= {chr(zero + i): str(i) for i in range(10)}
    return table


CHARACTERS = _characters()
_CHARACTER = re.compile("[" + re.escape("".join(sorted(CHARACTERS))) + "]")

# Spelled digits in English, German, French and Spanish.
DIGIT_WORDS = {
    word: str(digit)
    for digit, spelled in enumerate((
        "zero oh null zéro cero", "one eins un uno", "two zwei zwo deux dos", "three drei trois tres",
        "four vier quatre cuatro", "five fünf fuenf cinq cinco", "six sechs seis", "seven sieben sept siete",
        "eight acht huit ocho", "nine neun neuf nueve",
    ))
    for word in spelled.split()
}
#: An article too: alone among plain digits it is no digit.
_ARTICLE = "un"
_SPELLED = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_NUMBER = rf"(?:{_SPELLED}|[0-9])"
_DOT_WORD = "(?:dot|punkt|punto|point)"
_JOIN = rf"(?:[\x20\t\n,.-]{{1,3}}|\x20?\b{_DOT_WORD}\b\x20?)"
#: A run of at least four digits, spelled or not.
_RUN = re.compile(rf"(?:\b(?:plus|más|mas)\x20)?\b{_NUMBER}(?:{_JOIN}?{_NUMBER}){{3,}}\b", re.IGNORECASE)
#: Where a case-folded run may hold something to rewrite: a spelled digit beside a digit, or a spoken dot between digits.
_RUN_HINT = re.compile(
    rf"\b{_SPELLED}[\x20\t\n,.-]{{0,3}}(?:{_NUMBER}|{_DOT_WORD}\b)|[0-9][\x20\t\n,.-]{{0,3}}{_SPELLED}|[0-9]\x20{_DOT_WORD}\x20{_NUMBER}"
)
_RUN_PART = re.compile(
    rf"(?P<plus>(?:plus|más|mas)\x20)|(?P<spelled>{_SPELLED})|(?P<dot>\x20?\b{_DOT_WORD}\b\x20?)|(?P<gap>[\x20\t\n,]+)",
    re.IGNORECASE,
)

#: Letters that look like digits, in places where the shape asks for digits: four numbers with dots, groups of a card, a phone.
_ODD_DIGITS = re.compile(
    r"(?<![0-9A-Za-z.])(?:[0-9OolI]{1,3}(?:\.[0-9OolI]{1,3}){3}|[0-9OolI]{4}(?:[\x20-]?[0-9OolI]{4}){3}"
    r"|\+[0-9OolI]{1,3}(?:[\x20.-]?[0-9OolI]{2,4}){2,4})(?![0-9A-Za-z])"
)
_ODD = {"O": "0", "o": "0", "l": "1", "I": "1"}

_AT_WORD = "(?:at|arroba|arobase|arobas|klammeraffe|ät)"
_AT = rf"(?:{_AT_WORD}|@)"
_DOT = rf"(?:{_DOT_WORD}|\.)"
#: Signs in brackets, which take the blanks around them along; a pattern that began with blanks would try each of them.
_BRACKETED = re.compile(
    rf"[\[({{<][\x20\t]*(?:(?P<at>{_AT})|(?P<dot>{_DOT}))[\x20\t]*[\])}}>]", re.IGNORECASE
)
#: Signs that stand for themselves alone: references of HTML, and "(a)" inside a word.
_WRITTEN = re.compile(
    r"(?P<at>&#0*64;|&#x0*40;|&commat;|(?<=[A-Za-z0-9])[\[(]a[\])](?=[A-Za-z0-9]))|(?P<dot>&#0*46;|&#x0*2e;|&period;)",
    re.IGNORECASE,
)
_SPOKEN_DOT = rf"(?:\x20{_DOT_WORD}\x20|\x20\.\x20|_{_DOT_WORD}_|-{_DOT_WORD}-)"
_SPOKEN_AT = rf"(?:\x20{_AT_WORD}\x20|\x20@\x20|_{_AT_WORD}_|-{_AT_WORD}-)"
_SEPARATOR = re.compile(rf"\.|{_SPOKEN_DOT}", re.IGNORECASE)
#: Labels end where a spoken dot, or another at word, begins.
_HOST_LABEL = rf"(?:(?!-(?:{_DOT_WORD}|{_AT_WORD})-)[A-Za-z0-9-])+"
_SPOKEN_HOST = re.compile(
    rf"(?P<at>{_SPOKEN_AT}|@)(?P<host>{_HOST_LABEL}(?:(?:\.|{_SPOKEN_DOT}){_HOST_LABEL})+)", re.IGNORECASE
)
_SPOKEN_PART = re.compile(rf"(?P<at>{_SPOKEN_AT})|(?P<dot>{_SPOKEN_DOT})", re.IGNORECASE)
_LOCAL_LABEL = re.compile(r"[A-Za-z0-9_%+-]")
_BEFORE = re.compile(rf"(?:\.|{_SPOKEN_DOT})\Z", re.IGNORECASE)
_LONGEST_DOT = len("-punkt-")
#: Spoken signs that no sentence has by chance.
_SURE = re.compile(r"@|\x20dot\x20|\x20\.\x20|_|-(?:at|dot|punkt|punto|point)-|\x20(?:arroba|arobase|arobas|klammeraffe|ät)\x20", re.IGNORECASE)
# Last labels of hosts, the country codes and the usual others.
LAST_LABELS = frozenset(
    "com org net edu gov mil int info biz name pro dev app online site shop store tech cloud email mail blog wiki xyz "
    "museum aero coop jobs mobi travel cat eus gal berlin hamburg paris london example test local "
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf "
    "cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gd ge gf gg "
    "gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn "
    "kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na "
    "nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh "
    "si sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve "
    "vg vi vn vu wf ws ye yt za zm zw".split()
)
#: Those that are words of English, where "at this point in" is no address.
_WORDS_TOO = frozenset("am as at be by do id in is it me my no so to us pro name test example local online site shop store travel jobs cat".split())


class Rewritten:
    """A text and, for each of its characters, the source characters it stands for.

    Kept as pieces: where each piece begins here and in the source, and
    whether it was rewritten. A piece that was not has the source's length.
    """

    def __init__(self, text: str):
        self.text, self.starts, self.sources, self.changed = text, [0], [(0, len(text))], [False]

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of a span here, and whether it holds anything rewritten."""
        first = bisect.bisect_right(self.starts, start) - 1
        last = bisect.bisect_left(self.starts, end) - 1
        begin = self.sources[first][0] + (0 if self.changed[first] else start - self.starts[first])
        stop = self.sources[last][1] if self.changed[last] else self.sources[last][0] + end - self.starts[last]
        # What was left out altogether shows in the lengths.
        return begin, stop, any(self.changed[first : last + 1]) or stop - begin != end - start

    def replace(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """With these spans (sorted, disjoint) replaced; a replacement stands for all of its span."""
        out, done, here = Rewritten(""), 0, 0
        out.starts, out.sources, out.changed = [], [], []
        parts: list[str] = []

        def add(text: str, source: tuple[int, int], changed: bool) -> None:
            nonlocal here
            out.starts.append(here)
            out.sources.append(source)
            out.changed.append(changed)
            parts.append(text)
            here += len(text)

        def keep(start: int, end: int) -> None:
            i = bisect.bisect_right(self.starts, start) - 1
            while start < end:
                stop = min(end, self.starts[i + 1] if i + 1 < len(self.starts) else end)
                if stop > start:
                    begin, last, changed = self.source(start, stop)
                    add(self.text[start:stop], (begin, last), changed)
                start, i = stop, i + 1

        for start, end, new in edits:
            keep(done, start)
            if new:
                begin, last, _ = self.source(start, end)
                add(new, (begin, last), True)
            done = end
        keep(done, len(self.text))
        out.text = "".join(parts)
        return out if out.starts else Rewritten("")


def _plain_characters(text: Rewritten) -> Rewritten:
    if text.text.isascii() or CHARACTERS.keys().isdisjoint(set(text.text)):
        return text
    edits = [(m.start(), m.end(), CHARACTERS[m.group()]) for m in _CHARACTER.finditer(text.text)]
    return text.replace(edits) if edits else text


def _digits(text: Rewritten) -> Rewritten:
    if not _RUN_HINT.search(text.text.casefold()):
        return text
    edits = []
    for run in _RUN.finditer(text.text):
        parts = list(_RUN_PART.finditer(text.text, run.start(), run.end()))
        spelled = any(m.lastgroup == "spelled" and m.group().lower() != _ARTICLE for m in parts)
        for m in parts:
            word = m.group().lower()
            # Among plain digits only a spoken dot is a disguise.
            if spelled or m.lastgroup == "dot":
                new = {"plus": "+", "spelled": DIGIT_WORDS.get(word, ""), "dot": ".", "gap": ""}[m.lastgroup]
                edits.append((m.start(), m.end(), new))
    return text.replace(edits) if edits else text


def _odd_digits(text: Rewritten) -> Rewritten:
    """Letters that stand for digits, where at least every other sign is a digit."""
    edits = []
    for m in _ODD_DIGITS.finditer(text.text):
        odd = [i for i in range(m.start(), m.end()) if text.text[i] in _ODD]
        if odd and 2 * len(odd) <= sum(c.isalnum() for c in m.group()):
            edits += [(i, i + 1, _ODD[text.text[i]]) for i in odd]
    return text.replace(edits) if edits else text


def _in_brackets(text: str) -> list[tuple[int, int, str]]:
    """Bracketed signs with the blanks on both sides; each blank is looked at once."""
    edits, done = [], 0
    for m in _BRACKETED.finditer(text):
        start, end = m.span()
        while start > done and text[start - 1] in "\x20\t":
            start -= 1
        while end < len(text) and text[end] in "\x20\t":
            end += 1
        edits.append((start, end, "@" if m.lastgroup == "at" else "."))
        done = end
    return edits


def _at_and_dot(text: Rewritten) -> Rewritten:
    edits = [(m.start(), m.end(), "@" if m.lastgroup == "at" else ".") for m in _WRITTEN.finditer(text.text)]
    text = text.replace(edits) if edits else text
    edits = _in_brackets(text.text)
    text = text.replace(edits) if edits else text
    edits = []
    for whole in _spoken(text.text):
        for m in _SPOKEN_PART.finditer(text.text, *whole):
            edits.append((m.start(), m.end(), "@" if m.lastgroup == "at" else "."))
    return text.replace(edits) if edits else text


def _host_end(text: str, begin: int, end: int, plausible: frozenset) -> int:
    """The end of the longest host from `begin` whose last label, after a dot, is one of these; `begin` if there is none."""
    found, dots = begin, list(_SEPARATOR.finditer(text, begin, end))
    for dot, after in zip(dots, [*(m.start() for m in dots[1:]), end]):
        if text[dot.end() : after].lower() in plausible:
            found = after
    return found


def _spoken(text: str) -> Iterator[tuple[int, int]]:
    """Spoken addresses: from an at sign or word over the host, and back over the local part."""
    done, at = 0, 0
    while m := _SPOKEN_HOST.search(text, at):
        at = m.end("at")
        start = m.start()
        while True:
            label = start
            while label > done and _LOCAL_LABEL.match(text[label - 1]):
                label -= 1
            if label == start:
                break
            start = label
            before = _BEFORE.search(text, max(done, start - _LONGEST_DOT), start)
            if not before or before.start() <= done or not _LOCAL_LABEL.match(text[before.start() - 1]):
                break
            start = before.start()
        if start == m.start():
            continue
        end = m.end()
        # "at" and "point" are words of the language: the host has to end as hosts do.
        if not _SURE.search(m.group()):
            real = "." in m.group() and not re.search(rf"\x20{_DOT_WORD}\x20", m.group(), re.IGNORECASE)
            end = _host_end(text, m.start("host"), end, LAST_LABELS if real else LAST_LABELS - _WORDS_TOO)
            if end == m.start("host"):
                continue
        # A plain address needs no rewriting.
        if _SPOKEN_PART.search(text, start, end):
            yield start, end
        done = at = end


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, plain), by kind and then by start."""
    if not text:
        return []
    found = plain_spans(text)
    rewritten = _at_and_dot(_digits(_odd_digits(_plain_characters(Rewritten(text)))))
    more: set[Span] = set()
    if rewritten.text != text:
        for kind, a, b in plain_spans(rewritten.text):
            start, end, changed = rewritten.source(a, b)
            if changed and not any(k == kind and s <= start and end <= e for k, s, e in found):
                more.add((kind, start, end))
    every = [(*x, True) for x in found] + [(*x, False) for x in more]
    return sorted(every, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, and spans: an array of (kind, start, end, plain, value) for each document."""

    @F.pandas_udf("array<struct<kind: string, start: long, end: long, plain: boolean, value: string>>")
    def spans(text: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"kind": k, "start": s, "end": e, "plain": p, "value": t[s:e]} for k, s, e, p in find(t)]
                for t in text
            ],
            dtype=object,
        )

    return docs.select("doc_id", spans("text").alias("spans"))
