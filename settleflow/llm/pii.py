"""Personal data in text: plain identifiers and identifiers in disguise, with offsets into the source.

Plain spans follow fixed patterns: leftmost, non-overlapping for each kind; a match that fails its check
(range, Luhn, number of digits) is dropped without another try.

For disguises a text runs through three transducers, each of which rewrites characters and keeps, for every
character it writes, the stretch of the source it came from:

1. look-alike characters and other scripts' digits become ASCII, invisible characters go, O and l between digits become digits;
2. runs of three or more spelled digits ("plus one double five") become digits;
3. "at" and "dot", bracketed or between words, become @ and a full stop.

The same patterns then run over the result, and a match is mapped back to the source. It is added if a
transducer changed something in it and it overlaps no plain span, nor an added one of an earlier kind. A bare "at" counts
only before a domain whose dot was disguised too. Plain spans always stay.

Offsets are code points, the end exclusive. Defined results: null texts have no spans and stay null when redacted;
empty texts have none. Texts are read whole. The patterns have no start inside a run they have already
refused, so time stays in proportion to the length. Rows do not depend on each other.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# fixed values: characters that are drawn like an ASCII one
_LOOK_ALIKE = {
    "а": "a", "с": "c", "е": "e", "о": "o", "р": "p", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "К": "K", "М": "M", "О": "O", "Р": "P", "Т": "T", "Х": "X",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "ı": "i", "ɡ": "g", "ⅼ": "l", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "﹫": "@", "﹒": ".", "﹢": "+",
}
_INVISIBLE = "​‌‍⁠﻿­"
_DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_TIMES = {"double": 2, "triple": 3}


def _ascii_for(c: str) -> str:
    """The ASCII character that ``c`` stands for, or ``c``."""
    if c in _LOOK_ALIKE:
        return _LOOK_ALIKE[c]
    if "！" <= c <= "～":  # full width forms
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    return c if digit is None else str(digit)


_SINGLE = "".join(_LOOK_ALIKE) + _INVISIBLE
_STRANGE = re.compile(f"[{_SINGLE}！-～]|[^\x00-\x7f\\D]")
_MIXED = re.compile(r"(?<=[0-9])[OolI](?=[0-9])")
_WORD = "|".join(_DIGITS)
_TOKEN = re.compile(rf"\b(?:(double|triple)\s+)?({_WORD})\b|\b(dot|point)\b|\b(plus)\b|([0-9.])", re.I)
_SPELLED = re.compile(rf"(?:\bplus[\s,-]+)?\b(?:(?:double|triple)\s+)?(?:{_WORD})(?:[\s,.-]+(?:(?:dot|point)[\s,-]+)?(?:(?:double|triple)\s+)?(?:{_WORD}))"
                      r"{2,}\b", re.I)
_BRACKET = re.compile(r"(?<!\s)\s*(?:\[\s*(?:(at|@)|dot|\.)\s*\]|\(\s*(?:(at|@)|dot|\.)\s*\)|\{\s*(?:(at|@)|dot|\.)\s*\})\s*", re.I)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])", re.I)
_BARE_AT = re.compile(r"(?<=[A-Za-z0-9._%+-])\s+at\s+(?=([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+))", re.I)
_TRIGGER = re.compile(rf"\bdot\b|[\[({{]\s*(?:at|@|\.)\s*[\])}}]|\b(?:{_WORD})[\s,.-]+(?:(?:dot|point|double|triple)[\s,-]+)?(?:{_WORD})\b|[0-9][OolI][0-9]", re.I)

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    """Read from each @: its local part is the run of allowed characters before it, from the end of the last match on."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def _ips(text: str) -> list[Span]:
    def fits(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) <= 3 and int(part or "0") <= 255

    return [m.span() for m in _IP.finditer(text) if all(map(fits, m.group().split(".")))]


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) << (k & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(m.span())
    return out


def _phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]


_FIND = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


class _Tape:
    """A text under rewriting: its characters, where each came from, and whether it was rewritten."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.begin, self.end = list(range(len(text))), list(range(1, len(text) + 1))
        self.new = [False] * len(text)

    def rewrite(self, pattern: re.Pattern, rule) -> None:
        """``rule`` gives, for a match, its new characters as (character, start, end) in the present text, or None to leave it."""
        text, begin, end, new, at = [], [], [], [], 0
        for m in pattern.finditer(self.text):
            made = rule(m)
            if made is None:
                continue
            text.append(self.text[at:m.start()])
            begin += self.begin[at:m.start()]
            end += self.end[at:m.start()]
            new += self.new[at:m.start()]
            for c, i, j in made:
                text.append(c)
                begin.append(self.begin[i])
                end.append(self.end[j - 1])
                new.append(True)
            at = m.end()
        if at:
            self.text = "".join(text) + self.text[at:]
            self.begin, self.end, self.new = begin + self.begin[at:], end + self.end[at:], new + self.new[at:]


def _single(m: re.Match):
    c = m.group()
    return [] if c in _INVISIBLE else None if (to := _ascii_for(c)) == c else [(to, m.start(), m.end())]


def _digit_between(m: re.Match):
    return [("0" if m.group() in "Oo" else "1", m.start(), m.end())]


def _spelled(m: re.Match):
    out = []
    for t in _TOKEN.finditer(m.string, m.start(), m.end()):
        times, digit, point, plus, plain = t.groups()
        if digit:
            out += [(_DIGITS[digit.lower()], *t.span())] * _TIMES.get((times or "").lower(), 1)
        elif point:
            out.append((".", *t.span()))
        elif plus:
            out.append(("+", *t.span()))
    return out


def _bracket(m: re.Match):
    return [("@" if any(m.groups()) else ".", *m.span())]


def _disguised(text: str) -> _Tape:
    tape = _Tape(text)
    tape.rewrite(_STRANGE, _single)
    tape.rewrite(_MIXED, _digit_between)
    tape.rewrite(_SPELLED, _spelled)
    tape.rewrite(_BRACKET, _bracket)
    tape.rewrite(_BARE_DOT, lambda m: [(".", *m.span())])

    def bare_at(m: re.Match):
        i, j = m.span(1)
        return [("@", *m.span())] if any(tape.new[k] for k in range(i, j) if tape.text[k] == ".") else None

    tape.rewrite(_BARE_AT, bare_at)
    return tape


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """Spans as kind, start, end and whether plain, by start and then kind as listed."""
    if not text:
        return []
    found = [(kind, *span, True) for kind in KINDS for span in _FIND[kind](text)]
    if _TRIGGER.search(text) or not text.isascii() and _STRANGE.search(text):
        tape = _disguised(text)
        for kind in KINDS:
            for i, j in _FIND[kind](tape.text):
                start, end = tape.begin[i], max(tape.end[i:j])
                if any(tape.new[i:j]) and all(end <= a or b <= start for _, a, b, _ in found):
                    found.append((kind, start, end, False))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def span_column(text: Column) -> Column:
    """Array of structs ``kind``, ``start``, ``end``, ``plain``."""

    @pandas_udf("array<struct<kind:string,start:int,end:int,plain:boolean>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[dict(zip(("kind", "start", "end", "plain"), s)) for s in find_spans(t)] for t in batch], dtype=object)

    return spans(text)


def detect(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All rows and columns with ``spans``."""
    return docs.withColumn("spans", span_column(F.col(text)))


def digest(found: DataFrame) -> DataFrame:
    """Numbers of spans by kind and the spans as text, all and plain ones, in place of ``spans``."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    numbers = {f"n_{kind}": of(kind) for kind in KINDS}
    plain = F.filter("spans", lambda s: s["plain"])
    return found.withColumns(numbers | {"base_sha256": F.sha2(joined(plain).cast("binary"), 256), "_all": joined(F.col("spans"))}).withColumn("spans", F.col("_all")).drop("_all")


def redact_text(text: str | None) -> str | None:
    """The text with every span replaced by its kind; spans that overlap are replaced as one."""
    out, at = [], 0
    for kind, start, end, _ in find_spans(text):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return text if not out else "".join(out) + text[at:]


def redact(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All rows and columns, the text without personal data."""

    @pandas_udf("string")
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([redact_text(t) for t in batch], dtype=object)

    return docs.withColumn(text, cleaned(F.col(text)))
