import struct
import zlib
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

from conftest_llm import EDGES
from segwatch.llm.harmonic import classes, cut_lengths, harmonic_packing
from segwatch.llm.queries import VOCABULARY


def check(rows, source, capacity):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in source]
    pieces = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    counts = classes(capacity)
    wanted = Counter()
    for i, x in ids:
        at = 0
        for n, _ in cut_lengths(len(x), capacity, counts):
            wanted[i, at, n, zlib.crc32(struct.pack(f"<{n}I", *x[at:at + n])), len(x)] += 1
            at += n
        assert at == len(x)
    assert pieces == wanted
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append(r)
    assert sorted(by) == list(range(len(by)))
    short = Counter()
    for part in by.values():
        part.sort(key=lambda r: r["offset"])
        at = 0
        for r in part:
            assert r["offset"] == at
            at += r["length"]
        kinds = {r["class"] for r in part}
        assert at <= capacity and len(kinds) == 1 and len(part) <= part[0]["class"]
        short[part[0]["class"]] += len(part) < part[0]["class"]
    assert all(n <= 1 for n in short.values())  # one sequence of a class at most is not full
    return by


@pytest.mark.parametrize("parts", [1, 6])
def test_documents(documents, parts):
    df, source = documents
    check(harmonic_packing(df.repartition(parts), VOCABULARY).collect(), source, 4096)


def test_edges(edges):
    check(harmonic_packing(edges, VOCABULARY, capacity=64).collect(), EDGES, 64)
    assert harmonic_packing(edges.limit(0), VOCABULARY).collect() == []


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 4096])
def test_every_length_is_cut_with_little_waste(capacity):
    counts = classes(capacity)
    assert counts[0] == 1 and counts[-1] == capacity
    for tokens in range(1, 3 * capacity + 1):
        pieces = cut_lengths(tokens, capacity, counts)
        assert sum(n for n, _ in pieces) == tokens
        for n, kind in pieces:
            assert 0 < n <= capacity // kind


def test_padding_is_small(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "repeat('the ', cast(1 + pow(hash(id) % 1000, 2) / 400 AS int)) AS text")
    rows = harmonic_packing(df, VOCABULARY)
    total = rows.selectExpr("sum(length) AS n", "count(DISTINCT sequence_id) AS s").head()
    assert total["n"] > 0.93 * 4096 * total["s"]
