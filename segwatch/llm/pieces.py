"""The pieces a word tokenizer cuts a text into, and what its vocabulary file says about them."""

from __future__ import annotations

import re
import sys
import types
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import islice

# Below U+0180 composition changes nothing and lower case depends on the single sign; the listed
# punctuation and currency signs are as simple. There `str.split` also parts words where the tokenizer
# does, but for four control signs. Texts with any other sign go through the tokenizer's own
# normaliser and splitter, which is slower.
UNUSUAL = re.compile("[^\\x00-\\x1b\\x20-\\u012f\\u0131-\\u017f\\u2010-\\u2027\\u2030-\\u205e\\u20a0-\\u20bf]")
SPACE_SIGNS = "\\x09-\\x0d\\x20\\x85\\xa0"


def _signs(category: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(0x180) if unicodedata.category(chr(i))[0] == category)


_LETTERS, _NUMBERS = _signs("L"), _signs("N")
# Fixed value: the splitting pattern of the tokenizer file, written out for the signs above.
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{SPACE_SIGNS}{_LETTERS}{_NUMBERS}]+")
END = "</w>"
KEPT_WORDS = 600_000
PORTION_CHARS = 2_000_000


def byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 signs for
    themselves, the other bytes by the next free signs from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Splitter:
    """Cuts texts into words, and words into the pieces that the tokenizer encodes one by one."""

    def __init__(self, tokenizer):
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.byte_of = {sign: b for b, sign in enumerate(byte_signs())}

    def _segment(self, text: str) -> list[str]:
        if not UNUSUAL.search(text):
            return text.lower().split()
        pieces = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))
        # A leading space, which no word has, marks a piece as final.
        return [" " + bytes(self.byte_of[s] for s in piece).decode() for piece, _ in pieces]

    def words(self, text: str | None) -> list[str | int]:
        """Words to be cut by ``pieces``; special tokens come as their ids."""
        if not text:
            return []
        if "<|" not in text:
            return self._segment(text)
        out: list[str | int] = []
        for i, part in enumerate(self.marks.split(text)):
            if i % 2:
                out.append(self.special[part])
            else:
                out.extend(self._segment(part))
        return out

    @staticmethod
    def pieces(word: str) -> list[str]:
        return [word[1:]] if word[0] == " " else PIECE.findall(word)


def portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts of a batch in portions of bounded size, so that their words are not all held at once."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size > PORTION_CHARS:
            yield held
            held, size = [], 0
    yield held


def learn(known: dict[str | int, bytes], words: list[list[str | int]], splitter: Splitter, encode) -> None:
    """Add the ids of all new words, as 32-bit numbers. ``encode`` gives those of new pieces.

    A piece is a word too, so what is known of either serves both. Beyond the limit the words that came last
    go, since frequent ones come early.
    """
    if len(known) > KEPT_WORDS:
        for word in list(islice(known, KEPT_WORDS // 2, None)):
            del known[word]
    fresh = {w for found in words for w in found if w not in known}
    known.update((w, array("I", [w]).tobytes()) for w in fresh if isinstance(w, int))
    pieces = {w: splitter.pieces(w) for w in fresh if isinstance(w, str)}
    for piece, ids in encode(sorted({p for found in pieces.values() for p in found if p not in known})):
        known[piece] = array("I", ids).tobytes()
    for word, found in pieces.items():
        known[word] = b"".join([known[p] for p in found])


def worker_memory(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that tasks reuse what others found."""
    home = sys.modules.setdefault("segwatch_worker_memory", types.ModuleType("segwatch_worker_memory"))
    return home.__dict__.setdefault(name, {})
