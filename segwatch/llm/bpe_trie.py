"""BPE encoding of many words at once along a trie, and decoding.

The distinct words of a batch form a trie. Each of its nodes stands for a prefix, and needs only one number to be
encoded: the last token of the prefix's encoding. The rest is the encoding of the prefix before that token. The last token is the one
suffix that is a token by itself and that the merges would not join with, or take apart against, the
last token before it. Going through the words in order visits the trie depth first: the states of
shared prefixes are on a stack and are never computed again.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segwatch.llm.pieces import END, Splitter, byte_signs, learn, portions, worker_memory

PAIR_LIMIT = 2_000_000
FOREVER = float("inf")


class TrieEncoder:
    """The merges and tokens of a vocabulary file, with what has been found out about token pairs."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]]):
        self.vocab = vocab
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.token = [""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.token[i] = t
        self.parts = {a + b: (a, b) for a, b in self.rank}
        self.longest = max(map(len, vocab))
        self.signs = byte_signs()
        self.sizes = [len(self.symbols(t)) if t else 0 for t in self.token]
        self.spines: dict[tuple[int, int], list[tuple[str, float]]] = {}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    @staticmethod
    def symbols(token: str) -> list[str]:
        """The single signs a token is made of; the word end belongs to the last of them."""
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE: join the pair of lowest rank, the leftmost first, until none is left."""
        symbols = list(symbols)
        while len(symbols) > 1:
            found = [(self.rank.get(p), i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in self.rank]
            if not found:
                break
            _, i = min(found)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def stands(self, token: int) -> bool:
        """The merges make exactly this token of its own signs."""
        good = self.whole.get(token)
        if good is None:
            text = self.token[token]
            good = self.whole[token] = self.merge(self.symbols(text)) == [text]
        return good

    def _spine(self, token: int, side: int) -> list[tuple[str, float]]:
        """The first (0) or last (1) part of a token from single sign to whole, each with the rank of
        the merge that takes it up."""
        key = (token, side)
        spine = self.spines.get(key)
        if spine is None:
            text = self.token[token]
            parts = self.parts.get(text)
            if parts is None:
                spine = [(text, FOREVER)]
            else:
                inner = self._spine(self.vocab[parts[side]], side)
                spine = [*inner[:-1], (inner[-1][0], self.rank[parts]), (text, FOREVER)]
            self.spines[key] = spine
        return spine

    def fits(self, left: int, right: int) -> bool:
        """Two tokens next to each other stay as they are under the merges.

        While both are built up in order of rank, the sign groups that touch at the boundary change
        at the ranks on the two spines. A merge across the boundary happens if its rank comes up while
        both its parts are there; at one rank the pair further left is merged first.
        """
        key = left << 20 | right
        good = self.pairs.get(key)
        if good is not None:
            return good
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            across = self.rank.get((x, y))
            if across is not None and across < x_ends and across <= y_ends:
                good = False
                break
            if x_ends == y_ends == FOREVER:
                good = True
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        if len(self.pairs) > PAIR_LIMIT:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def _last(self, word: str, size: int, end: str, stack: list[int]) -> int:
        """The last token of ``word[:size]``, whose shorter prefixes have their last tokens on the stack.

        Only one suffix can be it, so the likely ones are tried first: the previous last token made
        longer by a sign, and the sign alone.
        """
        vocab = self.vocab
        longer = size - 1 - self.sizes[stack[size - 1]] if size > 1 else 0
        for start in (longer, size - 1, *range(max(0, size - self.longest), size - 1)):
            token = vocab.get(word[start:size] + end)
            if token is not None and (start == 0 or self.fits(stack[start], token)) and self.stands(token):
                return token
        raise ValueError(f"the vocabulary has no token for a sign of {word!r}")

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """``word, ids`` for each of the given distinct words, along the trie they form."""
        signs, sizes = self.signs, self.sizes
        before = ""
        stack = [-1]  # stack[n]: the last token of the prefix of n signs
        for shown, word in sorted(("".join([signs[b] for b in w.encode()]), w) for w in words):
            last = len(shown) - 1
            common = 0
            for a, b in zip(before, shown):
                if a != b:
                    break
                common += 1
            # The last sign carries the word end and is no prefix of longer words.
            del stack[min(common, last) + 1:]
            for size in range(len(stack), last + 1):
                stack.append(self._last(shown, size, "", stack))
            token = self._last(shown, last + 1, END, stack)
            ids, left = [token], last + 1 - sizes[token]
            while left:
                token = stack[left]
                ids.append(token)
                left -= sizes[token]
            before = shown
            yield word, ids[::-1]


def _load(path: str) -> tuple[TrieEncoder, Splitter, dict]:
    """The encoder of a vocabulary file; words and pairs found stay with the Python worker."""
    from tokenizers import Tokenizer

    memory = worker_memory(f"trie {path}")
    if not memory:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        memory["encoder"] = TrieEncoder(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        memory["splitter"] = Splitter(Tokenizer.from_file(path))
        memory["words"] = {}
        token = memory["encoder"].token
        for content, i in memory["splitter"].special.items():  # the model's own vocabulary need not list them
            token.extend([""] * (i + 1 - len(token)))
            token[i] = content
    return memory["encoder"], memory["splitter"], memory["words"]


def bpe_round_trip(df: DataFrame, vocabulary: str, text: str = "text", ids: bool = True) -> DataFrame:
    """Add ``token_ids`` (array of int), ``decoded`` (string) and their digests to every row of ``df``.

    ``vocabulary`` is the path of a tokenizer file on the executors. Columns added: ``n_tokens``
    (bigint), ``ids_sha256`` (of the ids as little-endian 32-bit numbers), ``decoded_sha256``, and with
    ``ids`` also ``token_ids`` and ``decoded`` themselves. Decoding joins the tokens with spaces, since
    the file has no decoder. NULL texts count as empty and give no tokens and an empty string.
    Special tokens inside a text give their own ids. One narrow stage: rows are neither moved nor
    compared, whatever repeats; a long text is one value and is held once.

    Columns of ``df`` with the names added are replaced.
    """
    added = {
        "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
        **({"token_ids": pa.list_(pa.int32()), "decoded": pa.string()} if ids else {}),
    }
    kept = df.select(*(c for c in df.columns if c not in added or c == text))
    at = kept.columns.index(text)
    out = [c for c in kept.columns if c not in added]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in out)
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string", "token_ids": "array<int>", "decoded": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, splitter, known = _load(vocabulary)
        token = encoder.token
        for batch in batches:
            rows = []
            for texts in portions(batch.column(at).to_pylist()):
                cut = [splitter.words(t) for t in texts]
                learn(known, cut, splitter, encoder.encode)
                for words in cut:
                    raw = b"".join([known[w] for w in words])
                    found = array("i", raw)
                    shown = " ".join([token[i] for i in found])
                    rows.append((len(found), hashlib.sha256(raw).hexdigest(), hashlib.sha256(shown.encode()).hexdigest(),
                                 *((found, shown) if ids else ())))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in out]
            columns += [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays(columns, names=[*out, *added])

    return kept.mapInArrow(run, ", ".join(filter(None, [schema, *(f"{c} {kinds[c]}" for c in added)])))
