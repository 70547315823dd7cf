import hashlib
import random
import struct
from collections import Counter

import pytest
from tokenizers import Tokenizer

from conftest_llm import EDGES
from segwatch.llm.bpe_trie import TrieEncoder, bpe_round_trip
from segwatch.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def plain(tokenizer, rows):
    out = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        shown = tokenizer.decode(ids, skip_special_tokens=False)
        out[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()] += 1
    return out


def result(df):
    return Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect())


def test_documents(documents, tokenizer):
    df, rows = documents
    assert result(bpe_round_trip(df, VOCABULARY, ids=False)) == plain(tokenizer, rows)


def test_edges(edges, tokenizer):
    done = bpe_round_trip(edges, VOCABULARY)
    assert result(done) == plain(tokenizer, EDGES)
    assert set(edges.columns) <= set(done.columns) and done.count() == len(EDGES)
    for r in done.where("doc_id = 11").collect():
        assert r["token_ids"] == tokenizer.encode(r["text"], add_special_tokens=False).ids
        assert r["decoded"] == tokenizer.decode(r["token_ids"], skip_special_tokens=False)
    assert bpe_round_trip(edges.limit(0), VOCABULARY).collect() == []


def test_odd_signs(spark, tokenizer):
    rng = random.Random(3)
    pool = [*map(chr, range(0x250)), *"’—…€Σς日한🎉´¨İſΩ", "'s", "'re", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "́", " ", "　"]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 80)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(bpe_round_trip(df, VOCABULARY, ids=False)) == plain(tokenizer, rows)


def test_trie_agrees_with_plain_merging():
    """A small vocabulary with overlapping merges, all words up to six signs."""
    merges = [("a", "a"), ("a", "b"), ("aa", "b</w>"), ("b", "a"), ("ab", "ab"), ("aa", "aa"), ("b", "a</w>"), ("ab", "a</w>"), ("aaaa", "b")]
    tokens = [*"ab", "a</w>", "b</w>", *("".join(m) for m in merges)]
    encoder = TrieEncoder({t: i for i, t in enumerate(tokens)}, merges)
    words = {bin(n)[3:].replace("0", "a").replace("1", "b") for n in range(2, 1 << 11)}
    found = dict(encoder.encode(words))
    assert set(found) == words
    for word in words:
        assert [encoder.token[i] for i in found[word]] == encoder.merge(encoder.symbols(word + "</w>"))
