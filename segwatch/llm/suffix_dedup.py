"""Removing strings of a given length that occur elsewhere, by sorting hashed suffixes.

The symbols of a string are bytes or whole words. Only suffixes that can matter are sorted. Every string of ``length``
symbols contains an anchor: the block of half its length whose hash is the smallest there. Equal strings have equal anchors at equal places, so a string whose
anchor's hash occurs once in the table has no equal. Around each shared anchor lies its context, the symbols
that any string with this anchor can cover. Contexts that are equal as a whole are covered as a whole.
Different contexts of one anchor are sorted by their suffixes: a mergesort whose comparisons find the common
extension by binary search on polynomial prefix hashes, checked against the symbols themselves afterwards. They are
sorted at the anchor, forwards and backwards, and again only where that leaves a string open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segwatch.functions.storage import cut

LENGTH = 400
PASSAGE_WORDS = 51
SEGMENT_BYTES = 1 << 20  # long texts are hashed in overlapping segments of this size
JOINED_BYTES = 1 << 18  # short texts are hashed together up to this size
SORTED_CONTEXTS = 4_096  # contexts of one anchor that one task sorts; beyond it their strings are counted in the whole table
SHARD_CONTEXTS = 2_048
BLOCKS = 2  # anchors to a string's length: shorter ones are fewer, but more of them are shared by other strings

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def _byte_values() -> np.ndarray:
    raw = b"".join(hashlib.blake2b(bytes([i]), digest_size=8).digest() for i in range(256))
    return np.frombuffer(raw, dtype="uint64")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype="uint64")
    out[:1] = 1
    return np.multiply.accumulate(out)


class Strings(NamedTuple):
    """What is looked for: strings of ``length`` bytes, or of ``length`` words whatever the blanks between them."""

    length: int = LENGTH
    words: bool = False


class Hasher:
    """Polynomial prefix hashes modulo 2**64 of bytes or of words' hashes, and hashes of blocks from them."""

    def __init__(self, n: int):
        self.values = _byte_values()
        self.powers = _powers(_MULTIPLIER, n + 1)
        self.inverses = _powers(pow(_MULTIPLIER, -1, 2**64), n + 1)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype="uint64")
        weights = self.values[data] if data.dtype == "uint8" else data
        np.cumsum(weights * self.powers[: len(data)], out=out[1:])
        return out

    def blocks(self, data: np.ndarray, size: int) -> np.ndarray:
        """A well mixed hash of each block of ``size`` bytes, by start."""
        prefixes = self.prefixes(data)
        return _mixed((prefixes[size:] - prefixes[:-size]) * self.inverses[: len(data) - size + 1])

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of ``data``: what lies between blanks. At most ``SEGMENT_BYTES`` are hashed
        at once, and a word longer than that by itself, in another way."""
        inside = np.zeros(len(data) + 2, dtype="int8")
        inside[1:-1] = IN_WORD[data]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        hashes = np.empty(len(starts), dtype="uint64")
        most = len(self.powers) - 1
        at = 0
        while at < len(starts):
            upto = int(np.searchsorted(ends, starts[at] + most, side="right"))
            if upto == at:
                digest = hashlib.blake2b(data[starts[at]:ends[at]].tobytes(), digest_size=8).digest()
                hashes[at] = int.from_bytes(digest, "little")
                at += 1
                continue
            low, high = int(starts[at]), int(ends[upto - 1])
            prefixes = self.prefixes(data[low:high])
            s, e = starts[at:upto] - low, ends[at:upto] - low
            hashes[at:upto] = _mixed((prefixes[e] - prefixes[s]) * self.inverses[s] + (e - s).astype("uint64"))
            at = upto
        return starts, ends, hashes


IN_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)], dtype="int8")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row: minima to both ends of blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo("uint64").max, dtype="uint64")
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1:n])


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` hashes in a row is; of equal ones the last."""
    low = np.uint64((1 << 21) - 1)
    least = _sliding_min((hashes & ~low) | (low - np.arange(len(hashes), dtype="uint64")), width)
    return (low - (least & low)).astype("int64")


def anchors(data: np.ndarray, hasher: Hasher, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the anchors: the blocks of smallest hash in some string of ``length`` symbols.

    The choice depends on the string alone; of equal smallest hashes the last counts.
    """
    block = max(1, length // BLOCKS)
    starts: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    for at in range(0, max(1, len(data) - length + 1), SEGMENT_BYTES):
        part = data[at:at + SEGMENT_BYTES + length - 1]
        if len(part) < length:
            continue
        found = hasher.blocks(part, block)
        chosen = _least_places(found, length - block + 1)
        chosen = np.unique(chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])])
        starts.append(chosen + at)
        hashes.append(found[chosen])
    if not starts:
        return np.empty(0, dtype="int64"), np.empty(0, dtype="uint64")
    where, first = np.unique(np.concatenate(starts), return_index=True)
    return where, np.concatenate(hashes)[first]


def _joined_anchors(raws: list[bytes], hasher: Hasher, length: int, words: bool) -> tuple[np.ndarray, ...]:
    """Anchors of several texts at once: text, place among all symbols and in its text, hash, symbols to the left and right
    that strings can cover; and the symbols. Short texts are joined, as each call costs more than their bytes."""
    block = max(1, length // BLOCKS)
    data = np.frombuffer(b"\n".join([*raws, b""]), dtype="uint8")
    ends = np.cumsum([len(r) + 1 for r in raws]) - 1
    low, high = ends - np.array([len(r) for r in raws]), ends
    symbols = data
    if words:
        starts, _, symbols = hasher.words(data)
        low, high = np.searchsorted(starts, low), np.searchsorted(starts, high)
    if len(raws) == 1:
        chosen, found = anchors(symbols[low[0]:high[0]], hasher, length)
        chosen = chosen + low[0]
    elif (high - low).max() < length:
        chosen, found = np.empty(0, dtype="int64"), np.empty(0, dtype="uint64")
    else:
        found = hasher.blocks(symbols, block)
        least = _least_places(found, length - block + 1)
        inside = np.zeros(len(least) + 1, dtype="int64")  # strings that lie in one text
        fits = high - low >= length
        np.add.at(inside, low[fits], 1)
        np.add.at(inside, high[fits] - length + 1, -1)
        chosen = least[np.cumsum(inside)[:-1] > 0]
        chosen = np.unique(chosen[np.append(True, chosen[1:] != chosen[:-1])])
        found = found[chosen]
    text = np.searchsorted(high, chosen, side="right")
    place = chosen - low[text]
    return text, chosen, place, found, np.minimum(place, length - block), np.minimum(high[text] - chosen, length), symbols


def _anchor_rows(wanted: Sequence[Strings]):
    # Strings of different kinds never share an anchor, and words count whatever lies between them.
    digest = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SEGMENT_BYTES + max(w.length for w in wanted))
        for batch in batches:
            rows: list[tuple[np.ndarray, ...]] = []
            contexts: list[np.ndarray] = []
            held = 0
            for first, raws in _joinable(batch.column(2)):
                for kind, (length, words) in enumerate(wanted):
                    text, chosen, place, found, left, right, symbols = _joined_anchors(raws, hasher, length, words)
                    if not len(chosen):
                        continue
                    whole, size = symbols.tobytes(), symbols.itemsize
                    bounds = map(slice, ((chosen - left) * size).tolist(), ((chosen + right) * size).tolist())
                    seeds = (left + (kind << 32)).tolist()
                    contexts.append(np.fromiter(map(digest, map(whole.__getitem__, bounds), seeds), dtype="uint64", count=len(chosen)))
                    held += len(chosen)
                    rows.append((text + first, np.full(len(text), kind, dtype="int8"), place, (found + np.uint64(kind)).view("int64"), left, right))
                if held > 1 << 17:
                    yield _anchor_batch(batch, rows, contexts)
                    rows, contexts, held = [], [], 0
            if rows:
                yield _anchor_batch(batch, rows, contexts)

    return run


def _joinable(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in runs of bounded size, with the number of the first; a long text is a run by itself."""
    first, held, size = 0, [], 0
    for n, text in enumerate(texts):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        if held and size + len(raw) + 1 > JOINED_BYTES:
            yield first, held
            first, held, size = n, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


def _anchor_batch(batch: pa.RecordBatch, rows: list[tuple[np.ndarray, ...]], contexts: list[np.ndarray]) -> pa.RecordBatch:
    n, kind, where, found, left, right = (np.concatenate(c) for c in zip(*rows))
    digests = pa.array(np.concatenate(contexts).view("int64"))
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(n)), batch.column(1).take(pa.array(n)), pa.array(kind), pa.array(found), digests,
         pa.array(where), pa.array(left.astype("int16")), pa.array(right.astype("int16"))],
        names=["doc", "mark", "kind", "hash", "context", "at", "left", "right"],
    )


class SuffixShard:
    """Contexts of several anchors, those of one beside each other (``groups`` ascends), framed so that the anchors stand at one
    place, with prefix hashes.

    The words of a context stand with one blank between them; they are compared by their hashes, and the strings
    found equal by their bytes.
    """

    def __init__(
        self, contexts: list[bytes], left: np.ndarray, groups: np.ndarray, length: int, salt: int = 0, words: Hasher | None = None
    ):
        block = max(1, length // BLOCKS)
        m, frame = len(contexts), 2 * length - block
        self.length, self.groups, self.shift = length, groups, length - block
        self.first = self.shift - left.astype("int64")
        self.contexts, self.cuts = contexts, None
        if words:
            sizes = np.array([c.count(b" ") + 1 for c in contexts])
            begin, end, flat = words.words(np.frombuffer(b" ".join(contexts), dtype="uint8"))
            flat = _mixed(flat ^ np.uint64(salt))
        else:
            flat, sizes = np.frombuffer(b"".join(contexts), dtype="uint8"), np.array([len(c) for c in contexts])
        self.bytes = np.zeros((m, frame), dtype=flat.dtype)
        self.last = self.first + sizes
        inside = (np.arange(frame) >= self.first[:, None]) & (np.arange(frame) < self.last[:, None])
        self.bytes[inside] = flat
        powers = _powers(_MULTIPLIER + 2 * salt, frame)
        self.hashes = np.zeros((m, frame + 1), dtype="uint64")
        np.cumsum((self.bytes if words else _byte_values()[self.bytes]) * powers, axis=1, out=self.hashes[:, 1:])
        if words:  # where the words begin and end in their context, by place
            base = np.repeat(np.cumsum([0] + [len(c) + 1 for c in contexts[:-1]]), sizes)
            self.cuts = np.zeros((2, m, frame), dtype="int64")
            self.cuts[0, inside], self.cuts[1, inside] = begin - base, end - base

    def extension(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, back: bool = False) -> np.ndarray:
        """Symbols that contexts ``a`` and ``b`` have in common from place ``p``, or before it, by binary search on the hashes."""
        low = np.zeros(len(a), dtype="int64")
        high = p - np.maximum(self.first[a], self.first[b]) if back else np.minimum(self.last[a], self.last[b]) - p
        flat, step = self.hashes.ravel(), -1 if back else 1
        from_a, from_b = a * self.hashes.shape[1] + p, b * self.hashes.shape[1] + p
        apart = flat[from_b] - flat[from_a]  # stays so as far as both have the same symbols
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = flat[from_b + step * middle] - flat[from_a + step * middle] == apart
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def _order(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, n: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """With ``n`` symbols in common: is the suffix of ``a`` before that of ``b``, which may begin with it; and are they equal."""
        at, end = (p - n, self.first) if back else (p + n, self.last)
        end_a, end_b = at == end[a], at == end[b]
        following = np.maximum(at - 1, 0) if back else np.minimum(at, self.bytes.shape[1] - 1)
        flat, width = self.bytes.ravel(), self.bytes.shape[1]
        return end_a | (~end_b & (flat[a * width + following] < flat[b * width + following])), end_a & end_b

    def less(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, back: bool = False) -> np.ndarray:
        """Suffix of ``a`` before that of ``b``; a suffix that the other begins with comes first, equals by what lies on the other
        side of ``p`` and then by number. With ``back`` the suffixes are read backwards, from the symbol before ``p``."""
        out, equal = self._order(a, b, p, self.extension(a, b, p, back), back)
        tied = np.flatnonzero(equal)
        if len(tied):
            a, b, p = a[tied], b[tied], p[tied]
            smaller, equal = self._order(a, b, p, self.extension(a, b, p, not back), not back)
            out[tied] = np.where(equal, a < b, smaller)
        return out

    def sort(self, context: np.ndarray, place: np.ndarray, back: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mergesort of suffixes within each (group, place): context, place and common extension with the one before.

        Runs of all parts are merged at once: a suffix's place in the merged run is its place in its own run plus the
        number of suffixes before it in the run beside it, found by binary search.
        """
        context, place, before, after, _ = self._sorted(context, place, back)
        return context, place, before if back else after

    def _sorted(self, context: np.ndarray, place: np.ndarray, back: bool) -> tuple[np.ndarray, ...]:
        """``sort`` with the symbols in common before and from ``place``, and whether a suffix is the first of its part."""
        part = self.groups[context] * (self.bytes.shape[1] + 1) + place
        order = np.argsort(part, kind="stable")
        context, place, part = context[order], place[order], part[order]
        n = len(context)
        new = np.concatenate([[True], part[1:] != part[:-1]]) if n else np.empty(0, dtype=bool)
        number = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, n))
        width, most = 1, int(size.max(initial=0))
        while width < most:
            who = np.flatnonzero(size[number] > width)
            base, count = begin[number[who]], size[number[who]]
            inside = who - base
            run, own = inside // width, inside % width
            beside = run ^ 1
            low = np.minimum(beside * width, count)
            high = np.minimum((beside + 1) * width, count)
            start = low.copy()
            while True:
                busy = np.flatnonzero(low < high)
                if not len(busy):
                    break
                middle = (low[busy] + high[busy]) // 2
                other = base[busy] + middle
                before = self.less(context[other], context[who[busy]], place[who[busy]], back)
                low[busy] = np.where(before, middle + 1, low[busy])
                high[busy] = np.where(before, high[busy], middle)
            target = base + (run // 2) * 2 * width + own + (low - start)
            moved = context.copy()
            moved[target] = context[who]
            context = moved
            width *= 2
        later = np.flatnonzero(~new)
        before, after = np.zeros(n, dtype="int64"), np.zeros(n, dtype="int64")
        pair = context[later - 1], context[later], place[later]
        before[later], after[later] = self.extension(*pair, back=True), self.extension(*pair)
        self._verify(*pair, before[later], after[later], back)
        return context, place, before, after, new

    def _verify(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, before: np.ndarray, after: np.ndarray, back: bool) -> None:
        """Every neighbour's common extensions are those of the symbols themselves, and the order that of the symbols."""
        columns = np.arange(self.bytes.shape[1])
        for at in range(0, len(a), 4096):
            some = slice(at, at + 4096)
            x, y, low, high = a[some], b[some], p[some] - before[some], p[some] + after[some]
            differ = self.bytes[x] != self.bytes[y]
            wrong = (differ & (columns >= low[:, None]) & (columns < high[:, None])).any()
            row = np.arange(len(x))
            more = low > np.maximum(self.first[x], self.first[y])
            wrong |= not differ[row[more], low[more] - 1].all()
            more = high < np.minimum(self.last[x], self.last[y])
            wrong |= not differ[row[more], high[more]].all()
            smaller, equal = self._order(x, y, p[some], before[some] if back else after[some], back)
            if wrong or not (smaller | equal).all():
                raise HashCollision
            if self.cuts is not None:
                equal = high - low >= self.length
                x, y, low, last = x[equal], y[equal], low[equal], high[equal] - 1
                spans = zip(x.tolist(), self.cuts[0, x, low].tolist(), self.cuts[1, x, last].tolist(),
                            y.tolist(), self.cuts[0, y, low].tolist(), self.cuts[1, y, last].tolist())
                if any(self.contexts[i][low:high] != self.contexts[j][begin:end] for i, low, high, j, begin, end in spans):
                    raise ArithmeticError("two different words have one 64-bit hash")

    def repeated(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``context, place`` of the first and the last string of the wanted length that also starts in another context of its group.

        Only contexts in ``wanted`` (a mask) are asked about; the others are what they are compared with. All strings of a
        context contain its anchor, so what lies between its first and its last changes nothing.

        The suffixes at the anchor are sorted, forwards and backwards. Neighbours there have the most in common to that side:
        this bounds the places, and where a neighbour has as much in common to both sides, it settles them. What is
        left open goes on from its outermost possible places. Sorting the suffixes there either finds that string, or the
        most in common rules out all places up to the next one that may do.
        """
        m = len(self.first)
        first, last = np.full(m, self.shift + 1), np.full(m, -1)  # outermost places found
        low, high = self.first.copy(), self.last - self.length  # outermost places possible
        context, place = np.arange(m), np.full(m, self.shift)
        self._tighten(context, place, first, last, low, high, True)
        self._tighten(context, place, first, last, low, high, False)
        for back in (True, False):
            while True:
                open_ones = np.flatnonzero(wanted & (low <= high) & ((low < first) if back else (high > last)))
                if not len(open_ones):
                    break
                # All contexts of a group that may have a string in common from the place in question on, or up to it.
                asked = np.unique(self.groups[open_ones] * (self.shift + 1) + (low if back else high)[open_ones])
                group, at = asked // (self.shift + 1), asked % (self.shift + 1)
                begin, end = np.searchsorted(self.groups, group), np.searchsorted(self.groups, group, side="right")
                size = end - begin
                context = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - begin, size)
                place = np.repeat(at, size)
                may = (low <= high)[context] & (high[context] >= place if back else low[context] <= place)
                context, place = context[may], place[may]
                self._tighten(context, place + self.length if back else place, first, last, low, high, back)
        found = np.flatnonzero(wanted & (last >= 0))
        return np.concatenate([found, found]), np.concatenate([first[found], last[found]])

    def _tighten(
        self, context: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray, back: bool
    ) -> None:
        """Sort the suffixes; note the outermost strings that neighbours share, and which places the most in common rules out."""
        context, place, before, after, new = self._sorted(context, place, back)
        later = np.flatnonzero(~new & (before + after >= self.length))
        for one in (context[later - 1], context[later]):
            np.minimum.at(first, one, place[later] - before[later])
            np.maximum.at(last, one, place[later] + after[later] - self.length)
        common = before if back else after
        most = np.maximum(common, np.append(common[1:], 0))
        if back:  # a string that begins at or before the place and does not end before it begins at most ``most`` symbols before
            ruled = low[context] >= place - self.length
            np.maximum.at(low, context[ruled], (place - most)[ruled])
        else:
            ruled = high[context] <= place
            np.minimum.at(high, context[ruled], (place + most - self.length)[ruled])


    def repeated_earlier(self) -> tuple[np.ndarray, np.ndarray]:
        """``context, place`` of every string of the wanted length that also starts in an earlier context of its group."""
        t = np.arange(self.shift + 1)
        context, place = np.nonzero((t >= self.first[:, None]) & (t <= self.last[:, None] - self.length))
        if not len(context):
            return context, place
        context, place, common = self.sort(context, place)
        part = self.groups[context] * self.bytes.shape[1] + place
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (common[1:] < self.length)])
        first = np.minimum.reduceat(context, np.flatnonzero(new))[np.cumsum(new) - 1]
        later = context > first
        return context[later], place[later]

class HashCollision(Exception):
    pass


def covered_ranges(
    contexts: list[bytes], left: np.ndarray, groups: np.ndarray, length: int, words: Hasher | None = None, keep_first: bool = False,
    wanted: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """For each context, the symbols covered by repeated strings, counted from the anchor; (0, 0) for none.

    All strings contain the anchor, so what they cover is one range. With ``keep_first`` strings count that an earlier
    context has, else those that any other has. A hash collision is found by the check of the sorted order
    and answered by sorting again under another multiplier.
    """
    salt = 0
    asked = np.ones(len(contexts), dtype=bool) if wanted is None else wanted
    while True:
        shard = SuffixShard(contexts, left, groups, length, salt, words)
        try:
            context, place = shard.repeated_earlier() if keep_first else shard.repeated(asked)
            break
        except HashCollision:
            salt += 1
    low = np.full(len(contexts), 2 * length, dtype="int64")
    high = np.zeros(len(contexts), dtype="int64")
    np.minimum.at(low, context, place)
    np.maximum.at(high, context, place + length)
    return np.where(high > 0, low - shard.shift, 0), np.where(high > 0, high - shard.shift, 0)


def _sorted_rows(wanted: Sequence[Strings], keep_first: bool):
    """Contexts arrive sorted by kind and anchor; whole anchors are gathered to shards and each shard is sorted."""

    def finish(table: pa.Table, hasher: Hasher) -> Iterator[pa.RecordBatch]:
        # Repeated rows of the input bring a context twice in a row; it is one place of the text.
        own, context = table.column("hash").to_numpy(), table.column("context").to_numpy()
        table = table.take(pa.array(np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (context[1:] != context[:-1])))))
        kinds = table.column("kind").to_numpy()
        for kind in np.unique(kinds):
            some = table.take(pa.array(np.flatnonzero(kinds == kind)))
            found = some.column("hash").to_numpy()
            groups = np.cumsum(np.concatenate([[0], found[1:] != found[:-1]]))
            length, words = wanted[kind]
            low, high = covered_ranges(
                some.column("bytes").to_pylist(), some.column("left").to_numpy(), groups, length, hasher if words else None, keep_first, some.column("n").to_numpy() == 1
            )
            good = np.flatnonzero(high > low)
            yield pa.RecordBatch.from_arrays(
                [some.column(c).combine_chunks().take(pa.array(good)) for c in ("hash", "context")]
                + [pa.array(low[good]), pa.array(high[good])], names=["hash", "context", "low", "high"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        hasher = Hasher(SEGMENT_BYTES)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            while rest.num_rows > SHARD_CONTEXTS:
                found = rest.column("hash").to_numpy()
                ends = np.flatnonzero(found[1:] != found[:-1]) + 1
                ends = ends[ends >= SHARD_CONTEXTS]
                if not len(ends):
                    break
                yield from finish(rest.slice(0, int(ends[0])), hasher)
                rest = rest.slice(int(ends[0]))
        if rest is not None and rest.num_rows:
            yield from finish(rest, hasher)

    return run


def _string_rows(wanted: Sequence[Strings]):
    """Every string of each context with its digest, for anchors with too many contexts for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, low, digests = [], [], []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("kind", "left", "bytes"))
            for n, (kind, left, raw) in enumerate(zip(*columns)):
                length, words = wanted[kind]
                symbols = raw.split(b" ") if words else raw
                for i in range(len(symbols) - length + 1):
                    string = symbols[i:i + length]
                    kept.append(n)
                    low.append(i - left)
                    digests.append(hashlib.blake2b(b" ".join(string) if words else string, digest_size=16).digest())
                if len(kept) > 1 << 16 or n == batch.num_rows - 1:
                    part = batch.drop_columns(["bytes", "left"]).take(pa.array(kept, pa.int64()))
                    yield part.append_column("low", pa.array(low, pa.int64())).append_column("string", pa.array(digests, pa.binary()))
                    kept, low, digests = [], [], []

    return run


def _compressed(df: DataFrame, doc: str, text: str, carry: Sequence[str]) -> DataFrame:
    """``doc, mark, packed, carried``: texts as they travel to the rows about them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = [pack(t.as_buffer()) if t.is_valid else None for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), *batch.columns[3:]],
                names=["doc", "mark", "packed", *batch.schema.names[3:]],
            )

    carried = F.struct(*(F.col(c) for c in carry)).alias("carried")
    rows = _named(df, doc, text, *([carried] if carry else []))
    schema = [("packed", "binary") if c == "text" else (c, kind) for c, kind in rows.dtypes]
    return rows.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in schema))


def _named(df: DataFrame, doc: str, text: str, *more: Column) -> DataFrame:
    """Documents go by their key and the hash of their text, since keys may be NULL or repeat."""
    return df.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"), *more)


def _merged(ranges: list[dict]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _apply(wanted: Sequence[Strings], kept_bytes: bool):
    """The strings of the first kind are taken out; of the others the symbols covered are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        hasher = Hasher(SEGMENT_BYTES)
        for batch in batches:
            sizes, removed, spans, digests, counts, texts = [], [], [], [], [], []
            for packed, ranges in zip(batch.column(1), batch.column(2).to_pylist()):
                raw = unpack(packed.as_py()) if packed.is_valid else b""
                by_kind = [_merged([r for r in ranges or () if r["kind"] == kind]) for kind in range(len(wanted))]
                merged = by_kind[0]
                if wanted[0].words and merged:
                    starts, ends, _ = hasher.words(np.frombuffer(raw, dtype="uint8"))
                    merged = [[int(starts[low]), int(ends[high - 1])] for low, high in merged]
                at, kept = 0, []
                for low, high in merged:
                    kept.append(raw[at:low])
                    at = high
                kept.append(raw[at:])
                left = b"".join(kept)
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                spans.append(merged)
                digests.append(hashlib.sha256(left).hexdigest())
                counts.append([sum(high - low for low, high in found) for found in by_kind])
                texts.append(left.decode("utf-8", "ignore") if packed.is_valid and kept_bytes else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[3:], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(digests, pa.string()),
                 pa.array(counts, pa.list_(pa.int64())), pa.array(texts, pa.string())],
                names=["doc", *batch.schema.names[3:], "n_bytes", "n_removed", "spans", "kept_sha256", "covered", "kept"],
            )

    return run


def suffix_dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, kept: bool = False, carry: Sequence[str] = (),
    words: bool = False, keep_first: bool = False, counted: Sequence[Strings] = (),
) -> DataFrame:
    """``key, n_bytes, n_removed, spans, kept_sha256, covered``: a row for each row of ``df``.

    With ``kept`` the text that is left is added (a character that lost some of its bytes is lost), and
    the columns named in ``carry`` come along as the struct ``carried``.

    A byte goes if some string of ``length`` bytes that covers it also starts anywhere else, in another row or in
    the same one; overlapping strings count, and all is judged on the input. With ``words`` the strings are of
    ``length`` words (what stands between blanks, whatever these are), and what goes are the bytes from the first
    covered word to the last. With ``keep_first`` a string's first place stays, in the document with the smallest
    key and there the smallest offset: only strings that also start earlier count. Strings named in ``counted`` are
    looked for in the same pass and not taken out; ``covered`` has the number of symbols covered for ``length`` and each of them.

    ``spans`` are the removed runs ``[start, end)`` in bytes. NULL and empty texts have no bytes; texts shorter than
    ``length`` lose none; very long texts are hashed in overlapping segments. Repeated rows are copies of each other and
    lose all that is long enough, but with ``keep_first`` rows with the same key and text are one document. NULL and
    repeated keys are fine, an empty table gives an empty result, and other columns are not read.

    Shuffled are: anchors (about one in 100 bytes or 14 words, 34 bytes each) by hash, the contexts of anchors with several, and
    the compressed texts, twice. Counts combine before the shuffle, joins are splittable, and an anchor with
    more than ``SORTED_CONTEXTS`` contexts is not sorted in one task: the digests of its strings (128 bits) are counted in the
    whole table. Contexts that are equal as a whole are told by the anchor's hash and a digest, 64 bits each.
    """
    wanted = (Strings(length, words), *counted)
    kind = df.schema[key].dataType.simpleString()
    placed = f"doc {kind}, mark bigint, kind tinyint, hash bigint, context bigint, at bigint, left smallint, right smallint"
    found = cut(_named(df, key, text).mapInArrow(_anchor_rows(wanted), placed), "anchors")
    # Both sides of the joins are read from files, so that Spark can split an anchor with many rows.
    shared = cut(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "shared-hashes")
    found = cut(found.join(shared, "hash"), "shared-anchors")

    contexts = found.groupBy("hash", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "at", "left", "right", "kind")).alias("one")
    )
    contexts = cut(contexts, "contexts")
    # An anchor is searched if some context of it is there once; the others are covered as a whole.
    alone = F.lit(keep_first) | (F.min("n") == 1)
    several = contexts.groupBy("hash").agg(F.count(F.lit(1)).alias("contexts"), alone.alias("open")).where("contexts > 1 and open")
    several = cut(several.drop("open"), "several")
    whole = contexts.where("n > 1").select(
        "hash", "context", F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("high"),
        F.struct("one.doc", "one.mark", "one.at").alias("first"),
    )
    asked = contexts.join(several, "hash").select("hash", "context", "contexts", "n", "one.*").groupBy("doc", "mark").agg(
        F.collect_list(F.struct("kind", "hash", "context", "contexts", "n", "at", "left", "right")).alias("cuts")
    )

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        hasher = Hasher(SEGMENT_BYTES)
        for batch in batches:
            at: list[int] = []
            out: list[tuple] = []
            for n, (packed, cuts) in enumerate(zip(batch.column(2), batch.column(3))):
                raw, bounds = unpack(packed.as_py()), None
                for c in cuts.as_py():
                    low, high = c["at"] - c["left"], c["at"] + c["right"]
                    if wanted[c["kind"]].words:
                        bounds = bounds or hasher.words(np.frombuffer(raw, dtype="uint8"))
                        body = b" ".join(raw[bounds[0][low]:bounds[1][high - 1]].split())
                    else:
                        body = raw[low:high]
                    at.append(n)
                    out.append((c["kind"], c["hash"], c["context"], c["contexts"], c["n"], c["at"], c["left"], body))
                if len(out) > 1 << 15 or n == batch.num_rows - 1:
                    keys = batch.select([0, 1]).take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*keys.columns, *_context_columns(out)], names=["doc", "mark", *_CONTEXT])
                    at, out = [], []

    packed = _compressed(df, key, text, carry)
    same = lambda left, right: left["doc"].eqNullSafe(right["doc"]) & (left["mark"] == right["mark"])
    texts = packed.join(asked, same(packed, asked)).select(packed["doc"], packed["mark"], "packed", "cuts")
    fields = ", ".join(f"{c} {t}" for c, (t, _) in _CONTEXT.items())
    bodies = cut(texts.mapInArrow(take, f"doc {kind}, mark bigint, {fields}"), "context-bytes")
    few = bodies.where(F.col("contexts") <= SORTED_CONTEXTS).select("kind", "hash", "context", "n", "left", "bytes", "doc", "mark", "at")
    ranged = few.repartition("hash").sortWithinPartitions("hash", "doc", "mark", "at", "context").mapInArrow(
        _sorted_rows(wanted, keep_first), "hash bigint, context bigint, low bigint, high bigint"
    )
    many = bodies.where(F.col("contexts") > SORTED_CONTEXTS).dropDuplicates(["hash", "context"])
    strings = many.select("doc", "mark", "at", "hash", "context", "kind", "left", "bytes").mapInArrow(
        _string_rows(wanted), f"doc {kind}, mark bigint, at bigint, hash bigint, context bigint, kind tinyint, low bigint, string binary"
    )
    place = F.struct("doc", "mark", "at")
    twice = strings.groupBy("hash", "low", "string").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    counts = strings.join(cut(twice, "twice"), ["hash", "low", "string"]).where(~(F.lit(keep_first) & place.eqNullSafe(F.col("first"))))
    sizes = F.create_map(*(F.lit(x) for i, w in enumerate(wanted) for x in (i, w.length)))
    counts = counts.select("hash", "context", "low", (F.col("low") + sizes[F.col("kind").cast("int")]).alias("high"))
    ranges = whole.unionByName(ranged.unionByName(counts), allowMissingColumns=True).groupBy("hash", "context").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("first").alias("first")
    )
    ranges = cut(ranges, "ranges")
    copy = F.col("first").isNotNull() & ~(F.lit(keep_first) & place.eqNullSafe(F.col("first")))
    low, high = F.when(copy, -F.col("left")).otherwise(F.col("low")), F.when(copy, F.col("right")).otherwise(F.col("high"))
    spans = found.join(ranges, ["hash", "context"]).withColumns({"from": F.col("at") + low, "upto": F.col("at") + high}).where("from is not null").select(
        "doc", "mark", F.struct("kind", F.col("from").alias("low"), F.col("upto").alias("high")).alias("span")
    ).groupBy("doc", "mark").agg(F.collect_set("span").alias("ranges"))
    rows = packed.join(spans, same(packed, spans), "left").select(
        packed["doc"], "packed", "ranges", *(["carried"] if carry else [])
    )
    carried = f"carried {packed.schema['carried'].dataType.simpleString()}, " if carry else ""
    schema = f"doc {kind}, {carried}n_bytes bigint, n_removed bigint, spans array<array<bigint>>, kept_sha256 string, covered array<bigint>, kept string"
    done = rows.mapInArrow(_apply(wanted, kept), schema).withColumnRenamed("doc", key)
    return done if kept else done.drop("kept")


_CONTEXT = {
    "kind": ("tinyint", pa.int8()), "hash": ("bigint", pa.int64()), "context": ("bigint", pa.int64()), "contexts": ("bigint", pa.int64()),
    "n": ("bigint", pa.int64()), "at": ("bigint", pa.int64()), "left": ("smallint", pa.int16()), "bytes": ("binary", pa.binary()),
}


def _context_columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_CONTEXT.values())]
