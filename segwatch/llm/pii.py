"""Personal data in plain and in disguise, with positions in the text as it was given.

Small transducers undo disguises: look-alike signs, invisible signs, digits spelled as words, and "at" and "dot"
in words or brackets. They write a plain text and remember which stretch of the source each sign
stands for. The identifiers found in it are mapped back to the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# What the four kinds look like, and how many digits they have.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

# Look-alikes of Latin letters, as "letter: look-alikes".
LOOK_ALIKES = (
    "a: аα", "b: Ьƅ", "c: сϲ", "d: ԁ", "e: еє", "g: ɡ", "h: һ", "i: іιı", "j: јϳ", "k: кκ", "l: ӏⅼ", "m: м", "n: ո",
    "o: оοօ", "p: рρ", "q: ԛ", "r: г", "s: ѕ", "t: т", "u: υս", "v: νѵ", "w: ѡԝ", "x: хχ", "y: уγү", "z: ᴢ",
    "A: АΑ", "B: ВΒ", "C: СϹ", "E: ЕΕ", "H: НΗ", "I: ІΙ", "J: Ј", "K: КΚ", "M: МΜ", "N: Ν", "O: ОΟ", "P: РΡ",
    "S: Ѕ", "T: ТΤ", "X: ХΧ", "Y: ΥҮ", "Z: Ζ", "@: ＠﹫", ".: ．。․﹒", "-: ‐‑‒–−－", "+: ＋﹢",
)
# The digits from 0 to 9 in words.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
LEAST_DIGIT_WORDS = 4

SIGN = {alike: line[0] for line in LOOK_ALIKES for alike in line[3:]}
DIGIT = {word: str(i) for line in DIGIT_WORDS for i, word in enumerate(line.split())}
INVISIBLE = "­​‌‍⁠﻿"
_WORD = "(?:" + "|".join(sorted(DIGIT, key=len, reverse=True)) + ")"
SPELLED = re.compile(rf"(?i)(?<!\w)(?:plus[\s]+)?{_WORD}(?:[\s,.-]{{1,3}}(?:{_WORD}|[0-9]+)(?!\w)){{{LEAST_DIGIT_WORDS - 1},}}")
SPELLED_PART = re.compile(rf"(?i)plus|{_WORD}|[0-9]")
# A run of blanks is entered at its start only, so that long runs are read once.
_OPEN, _CLOSE = r"(?<!\s)\s*+[\[({<]\s*+", r"\s*+[\])}>]\s*+"
_DOT = r"(?:dot|punkt|point|punto)"
_HIDDEN_DOT = rf"(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|\s+{_DOT}\s+)"
AT_DOT = re.compile(
    rf"(?i)(?P<at>{_OPEN}(?:at|@|arobase|arroba){_CLOSE}|&#64;|&commat;|(?<=[\w%+-])\s+at\s+(?=[\w-]+(?:{_HIDDEN_DOT}[\w-]+)+))"
    rf"|(?P<dot>(?<=[\w-]){_HIDDEN_DOT}(?=[\w-])|&#46;|&period;)"
)
# Every match of the pattern above holds one of these or, after a plain "at", is followed by one: without any, there is none.
AT_DOT_CORE = re.compile(rf"[\[({{<]\s*+(?:at|@|arobase|arroba|{_DOT}|\.)\s*+[\])}}>]|&#64;|&commat;|&#46;|&period;|\s{_DOT}\s")
# Two digit words, or one and a digit, in a row: what every spelled number has after its first word.
SPELLED_HINT = re.compile(rf"[\s,.-]{_WORD}[\s,.-]{{1,3}}(?:{_WORD}|[0-9])")
_OTHER_DIGITS = "".join(c for c in map(chr, range(0x80, 0x11000)) if unicodedata.decimal(c, None) is not None)
ODD = re.compile(f"[{INVISIBLE}！-～{re.escape(''.join(SIGN))}{_OTHER_DIGITS}]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def find_plain(text: str) -> list[Span]:
    """Identifiers as written: leftmost matches of each kind that do not overlap; failing ones are dropped."""
    found: list[Span] = []
    end = 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in LOCAL_SIGNS:
                start -= 1
            if start < m.start():
                end = m.end()
                found.append(("email", start, end))
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m.group().replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(map(str.isdigit, m.group())) <= PHONE_DIGITS[1]:
                found.append(("phone", *m.span()))
    return found


def _sign(c: str) -> str:
    """What one unusual sign stands for: a Latin look-alike, a plain digit, nothing, or itself."""
    if c in INVISIBLE:
        return ""
    if c in SIGN:
        return SIGN[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    return c if digit is None else str(digit)


class Plain:
    """A text with parts replaced, and the way back: each sign of it knows its stretch of the source."""

    def __init__(self, text: str):
        self.text = text
        # From sign `at[i]` on, plain sign n stands for source sign n + shift[i], unless `span[i]` gives one stretch for all.
        self.at, self.source, self.fixed = [0], [0], [None]

    def rewrite(self, parts: Iterator[tuple[int, int, str]]) -> Plain:
        """Replace the given stretches ``start, end, new`` of this text."""
        out, pieces, size, last = Plain(""), [], 0, 0
        out.at, out.source, out.fixed = [], [], []

        def keep(start: int, end: int) -> None:
            nonlocal size
            i = bisect_right(self.at, start) - 1
            while start < end:
                stop = min(end, self.at[i + 1] if i + 1 < len(self.at) else end)
                fixed = self.fixed[i]
                out.at.append(size)
                out.source.append(self.source[i] + (0 if fixed else start - self.at[i]))
                out.fixed.append(fixed)
                pieces.append(self.text[start:stop])
                size += stop - start
                start, i = stop, i + 1

        for start, end, new in parts:
            keep(last, start)
            if new:
                low, high = self.back(start, end)
                out.at.append(size)
                out.source.append(low)
                out.fixed.append((low, high))
                pieces.append(new)
                size += len(new)
            last = end
        keep(last, len(self.text))
        out.text = "".join(pieces)
        return out

    def _stretch(self, n: int) -> tuple[int, int]:
        i = bisect_right(self.at, n) - 1
        if self.fixed[i]:
            return self.fixed[i]
        place = self.source[i] + n - self.at[i]
        return place, place + 1

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._stretch(start)[0], self._stretch(end - 1)[1]

    def touched(self, start: int, end: int) -> bool:
        """Some sign from ``start`` to ``end`` was rewritten, or signs between them were taken out."""
        first, last = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        return first < last or self.fixed[first] is not None


def _spelled(text: str) -> Iterator[tuple[int, int, str]]:
    for m in SPELLED.finditer(text):
        digits = list(SPELLED_PART.finditer(m.group()))
        if sum(d.group().lower() in DIGIT for d in digits) < LEAST_DIGIT_WORDS:
            continue
        for before, d in zip([None, *digits], digits):
            low = m.start() + (before.end() if before else 0)
            if low < m.start() + d.start():
                yield low, m.start() + d.start(), ""
            word = d.group().lower()
            yield m.start() + d.start(), m.start() + d.end(), "+" if word == "plus" else DIGIT.get(word, word)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and the spans added by undoing disguises (none of them touches a plain one of its kind)."""
    plain = find_plain(text)
    shown = Plain(text)
    if not text.isascii() and ODD.search(text):
        shown = shown.rewrite((m.start(), m.end(), _sign(m.group())) for m in ODD.finditer(text))
    lower = shown.text.lower()
    if SPELLED_HINT.search(lower):
        shown = shown.rewrite(_spelled(shown.text))
    if AT_DOT_CORE.search(lower):
        shown = shown.rewrite((m.start(), m.end(), "@" if m["at"] else ".") for m in AT_DOT.finditer(shown.text))
    if len(shown.at) <= 1 and shown.text == text:
        return plain, []
    added: list[Span] = []
    own: dict[str, list[Span]] = {k: [s for s in plain if s[0] == k] for k in KINDS}
    passed, last = dict.fromkeys(KINDS, 0), dict.fromkeys(KINDS, 0)
    for kind, start, end in find_plain(shown.text):  # in order for each kind, as the plain spans are
        if shown.touched(start, end):
            low, high = shown.back(start, end)
            n = passed[kind]
            while n < len(own[kind]) and own[kind][n][2] <= low:
                n += 1
            passed[kind] = n
            if low >= last[kind] and (n == len(own[kind]) or own[kind][n][1] >= high):
                added.append((kind, low, high))
                last[kind] = high
    return plain, added


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; spans that overlap become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def personal_data(df: DataFrame, text: str = "text", redacted: bool = False) -> DataFrame:
    """Add to every row of ``df`` what personal data its text holds.

    ``n_email, n_ip, n_card, n_phone`` (bigint) count the plain spans, ``base_sha256`` is the digest of
    these, ``spans`` lists all spans as ``kind:start:end`` by kind and start (code points, end exclusive),
    ``n_added`` counts those found in disguise, and with ``redacted`` the text itself is replaced by one with every span
    masked. NULL texts count as empty and stay NULL, empty texts hold nothing, a very long text takes time in
    proportion to its length, repeated rows are treated alike, an empty table stays empty, and other columns
    pass through unless they have one of these names. One narrow stage without any shuffle.
    """
    counts = [f"n_{k}" for k in KINDS]
    added = [*counts, "base_sha256", "spans", "n_added"]
    kept = df.select(*(c for c in df.columns if c not in added or c == text))
    at = kept.columns.index(text)
    out = [c for c in kept.columns if redacted or c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for value in batch.column(at).to_pylist():
                plain, more = find(value or "")
                kinds = [s[0] for s in plain]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(joined(plain).encode()).hexdigest(), joined(plain + more), len(more)))
                if redacted:
                    texts.append(value and redact(value, plain + more))
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(batch.schema.get_field_index(c)) for c in out]
            types = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
            columns += [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=[*out, *added])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in out]
    schema += [f"{c} {'string' if c in ('base_sha256', 'spans') else 'bigint'}" for c in added]
    return kept.mapInArrow(run, ", ".join(schema))
