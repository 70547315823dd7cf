"""Exact encoding with a merge-type piece vocabulary by backtracking, and decoding.

The merges join the neighbours whose union is the best scored piece, the leftmost first, until none is left. Their
result is the one sequence of pieces in which every piece is what the merges make of its own signs and every two
neighbours stay apart under the merges. So it can be searched from the left without merging: take the longest piece
that begins here (an Aho-Corasick automaton gives them all in one run over the word), check it against the piece before it
by undoing merges at their boundary, else try the next shorter one, and go back a piece if none is left. A bit for each
position remembers that nothing fits from there on, so no position is tried twice.

No piece has a blank after another sign, so a text falls into words that are encoded by themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from segwatch.llm.pieces import portions, worker_memory

BLANK = "▁"
WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
KEPT_WORDS = 600_000  # words a Python worker remembers between portions of text
KEPT_SIGNS = 100  # longer words are encoded again each time
PAIR_LIMIT = 2_000_000


class BacktrackEncoder:
    """Pieces with their ranks (0 is merged first, equal scores share a rank) and the automaton that finds them."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        """``pieces`` gives id and score of each piece that merges may make, ``byte_ids`` the ids of the 256 bytes."""
        import ahocorasick

        order = {score: rank for rank, score in enumerate(sorted({s for _, s in pieces.values()}, reverse=True))}
        self.rank = {piece: order[score] for piece, (_, score) in pieces.items()}
        self.ids = {piece: i for piece, (i, _) in pieces.items()}
        self.byte_ids = byte_ids
        if any(BLANK in piece.lstrip(BLANK) for piece in pieces):
            raise ValueError("a piece with a blank after another sign spans words")
        self.parts: dict[str, tuple[str, str]] = {}  # the two neighbours that the last merge of a piece joins
        automaton = ahocorasick.Automaton()
        for piece in sorted(pieces, key=len):
            if len(piece) == 1:
                automaton.add_word(piece, piece)
                continue
            joined = self.merge(list(piece), stop=2)
            if len(joined) == 2:
                self.parts[piece] = (joined[0], joined[1])
                automaton.add_word(piece, piece)
        automaton.make_automaton()
        self.automaton = automaton
        self.shorter: dict[str, str | None] = {}  # the next shorter piece with which a piece begins
        for piece in self.parts:
            found = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[piece] = next((p for p in found if p in self.parts or len(p) == 1 and p in self.rank), None)
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, symbols: list[str], stop: int = 1) -> list[str]:
        """The merges themselves: best rank first, leftmost first, down to ``stop`` symbols."""
        while len(symbols) > stop:
            ranks = [self.rank.get(a + b) for a, b in zip(symbols, symbols[1:])]
            possible = [(r, i) for i, r in enumerate(ranks) if r is not None]
            if not possible:
                break
            _, i = min(possible)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def apart(self, left: str, right: str) -> bool:
        """The merges of ``left + right`` end with these two pieces; found out once and kept in ``pairs``.

        The merges of both are undone from the last one back. Between two undone merges the same two parts touch; if
        their union is a piece whose turn comes within that time, the merges would have crossed the boundary.
        Of merges of one rank the one further left comes first: those inside ``left`` before the one
        across, that before those inside ``right``.
        """
        rank, parts = self.rank, self.parts
        a, b, before, good = left, right, len(rank) + 1, True
        while a in rank and b in rank:  # a sign without piece takes part in no merge
            across = rank.get(a + b)
            if across is not None and across < before:
                good = False
                break
            of_a, of_b = rank[a] if a in parts else -1, rank[b] if b in parts else -1
            if of_a < 0 and of_b < 0:
                break
            if of_a > of_b:
                a, before = parts[a][1], of_a
            else:
                b, before = parts[b][0], of_b + 1
        if len(self.pairs) >= PAIR_LIMIT:
            self.pairs.clear()
        self.pairs[left, right] = good
        return good

    def split(self, word: str) -> list[str]:
        """The pieces of ``word``; a sign that is no piece stands for itself."""
        n = len(word)
        longest: list[str | None] = list(word)
        for end, piece in self.automaton.iter(word):  # of those with one start the longer ends later
            longest[end + 1 - len(piece)] = piece
        longest.append(None)
        shorter, pairs = self.shorter, self.pairs
        failed: bytearray | None = None  # a bit for each position from which no way leads on
        out: list[str] = []
        at, piece, last = 0, longest[0], None
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    good = pairs.get((last, piece))
                    if good or good is None and self.apart(last, piece):
                        break
                piece = shorter.get(piece)
            if piece is None:
                if last is None:
                    raise ValueError(f"no sequence of pieces for a word of {n} signs")
                failed = failed or bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(last)
                piece = shorter.get(out.pop())
                last = out[-1] if out else None
            else:
                out.append(piece)
                at, last, piece = end, piece, longest[end]
        return out

    def encode(self, word: str) -> list[int]:
        pieces = self.split(word)
        try:
            return [self.ids[piece] for piece in pieces]
        except KeyError:
            return [i for piece in pieces for i in ([self.ids[piece]] if piece in self.ids else [self.byte_ids[b] for b in piece.encode()])]


class Decoder:
    """Text from ids: pieces with blanks for their marks, runs of byte pieces as UTF-8."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.raw = {i: piece.replace(BLANK, " ").encode() for piece, (i, _) in pieces.items()}
        self.raw.update((i, bytes([b])) for b, i in enumerate(byte_ids))

    def word(self, ids: list[int]) -> str:
        return b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")

    @staticmethod
    def text(words: list[str]) -> str:
        """The words of a whole text joined, without the blank that encoding put before it."""
        return "".join(words)[1:] if words and words[0][0] == " " else "".join(words)


def _load(model: str) -> dict:
    """Encoder, decoder, normaliser and the words known so far; they stay with the Python worker."""
    memory = worker_memory(f"pieces {model}")
    if not memory:
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=model)
        plain = [i for i in range(len(library)) if not (
            library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        pieces = {library.id_to_piece(i): (i, library.get_score(i)) for i in plain}
        byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(library.is_byte, byte_ids)):
            raise ValueError(f"{model} has no byte pieces")
        memory.update(encoder=BacktrackEncoder(pieces, byte_ids), decoder=Decoder(pieces, byte_ids),
                      normalize=library.normalize, names=list(map(str, range(len(library)))), ids={}, texts={})
    return memory


def _learn(memory: dict, words: list[list[str]]) -> list[str]:
    """Encode and decode the words not known yet. Returns the long ones, to be forgotten after use."""
    ids, texts = memory["ids"], memory["texts"]
    if len(ids) > KEPT_WORDS:  # frequent words come early
        for word in list(islice(ids, KEPT_WORDS // 2, None)):
            del ids[word], texts[word]
    fresh = set().union(*words).difference(ids)
    encode, decode, names = memory["encoder"].encode, memory["decoder"].word, memory["names"]
    for word in fresh:
        found = encode(word)
        ids[word] = ",".join([names[i] for i in found])
        texts[word] = decode(found)
    return [w for w in fresh if len(w) > KEPT_SIGNS]


def piece_round_trip(df: DataFrame, model: str, text: str = "text", ids: bool = True) -> DataFrame:
    """Add the pieces of every text and what they decode to, as columns of every row of ``df``.

    ``model`` is the path of a merge-type sentencepiece file with byte pieces on the executors. Columns added:
    ``n_tokens`` (bigint), ``ids_sha256`` (of the decimal ids joined by commas), ``decoded_sha256``, and with ``ids`` also
    ``token_ids`` (array of int) and ``decoded`` themselves. The normaliser is the model's own; encoding and
    decoding are the methods above, without begin and end ids.

    NULL and empty texts have no tokens and decode to the empty string. One narrow stage: rows are neither moved nor
    compared, so repeated rows and keys mean nothing to it and an empty table stays empty. A very long text is
    held once; a very long word takes one list entry a sign and time in proportion to its length. Columns of
    ``df`` with the names added are replaced.
    """
    added = {
        "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
        **({"token_ids": pa.list_(pa.int32()), "decoded": pa.string()} if ids else {}),
    }
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string", "token_ids": "array<int>", "decoded": "string"}
    kept = df.select(*(c for c in df.columns if c not in added or c == text))
    at = kept.columns.index(text)
    out = [c for c in kept.columns if c not in added]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _load(model)
        numbers, texts = memory["ids"], memory["texts"]
        for batch in batches:
            rows = []
            for portion in portions(batch.column(at).to_pylist()):
                cut = [WORD.findall(memory["normalize"](t)) if t else [] for t in portion]
                long = _learn(memory, cut)
                for words in cut:
                    joined = ",".join(map(numbers.__getitem__, words))
                    shown = Decoder.text(list(map(texts.__getitem__, words)))
                    rows.append((
                        joined.count(",") + 1 if joined else 0,
                        hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest(),
                        *(([int(i) for i in joined.split(",")] if joined else [], shown) if ids else ()),
                    ))
                for word in long:
                    del numbers[word], texts[word]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in out]
            columns += [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays(columns, names=[*out, *added])

    return kept.mapInArrow(run, ", ".join(filter(None, [schema, *(f"{c} {kinds[c]}" for c in added)])))
