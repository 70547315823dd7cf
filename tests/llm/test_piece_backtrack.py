"""Pieces by backtracking against the library, on odd texts and on the whole small table."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from segwatch.llm.piece_backtrack import BLANK, WORD, BacktrackEncoder, Decoder, _load, piece_round_trip

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def odd_texts(n):
    draw = random.Random(7)
    pieces = [p.replace(BLANK, " ") for p in sorted(_load(MODEL)["encoder"].ids)]
    signs = "ab et is the ingé日本語🎉\n\t  ▁　\x00ﬁ①0123.,;<>|_-="
    for k in range(n):
        source = (signs, pieces, "abcdefghijklmnopqrstuvwxyz", [" "] * 6 + ["a", "==", "\n", " the"])[k % 4]
        yield "".join(draw.choice(source) for _ in range(draw.randint(0, 40)))


def test_ids_and_text_of_odd_strings(library):
    memory = _load(MODEL)
    for text in [*odd_texts(4000), " ", "  ", " " * 100, "<0x41></s><unk>", "x" * 20_000, "日" * 3000 + "the" * 5000]:
        words = WORD.findall(memory["normalize"](text)) if text else []
        ids = [memory["encoder"].encode(w) for w in words]
        assert sum(ids, []) == library.encode(text), repr(text)
        assert Decoder.text([memory["decoder"].word(i) for i in ids]) == library.decode(library.encode(text)), repr(text)


def test_a_vocabulary_that_needs_to_go_back():
    """The longest first piece leads nowhere, and a piece that no merges make is not used."""
    pieces = {p: (i, -float(i)) for i, p in enumerate(["b", "a", "c", "d", "bc", "ab", "bcd", "abcd", "cda"])}
    encoder = BacktrackEncoder(pieces, list(range(256)))
    draw = random.Random(1)
    for _ in range(3000):
        word = "".join(draw.choice("abcdx") for _ in range(draw.randint(1, 14)))
        assert encoder.split(word) == encoder.merge(list(word)), word


def test_blanks_inside_pieces_are_refused():
    with pytest.raises(ValueError, match="spans words"):
        BacktrackEncoder({"a": (0, 0.0), "a▁b": (1, -1.0)}, list(range(256)))


def check(df, library, ids):
    rows = piece_round_trip(df, MODEL, ids=ids).collect()
    assert len(rows) == df.count()
    for r in rows:
        expected = library.encode(r["text"] or "")
        assert r["n_tokens"] == len(expected)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(expected).encode()).hexdigest()
        if ids:
            assert r["token_ids"] == expected and r["decoded"] == library.decode(expected)
    return rows


def test_whole_table(spark, documents, library):
    check(documents[0].select("doc_id", "text"), library, ids=False)


def test_edges_and_columns_of_the_same_names(spark, edges, library):
    df = edges.withColumnRenamed("spans", "token_ids").withColumnRenamed("size", "n_tokens")
    rows = check(df, library, ids=True)
    assert sorted(rows[0].asDict()) == sorted([*df.columns, "ids_sha256", "decoded_sha256", "decoded"])
    assert piece_round_trip(df.limit(0), MODEL).count() == 0
