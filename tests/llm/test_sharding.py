import zlib
from collections import Counter, defaultdict

import pytest

from conftest_llm import EDGES
from segwatch.llm import sharding
from segwatch.llm.sharding import byte_shards


def check(rows, source, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source
    )
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
    assert keys == sorted(keys)  # contiguous in key order
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for shard in range(shards):
        assert abs(sum(r["size"] for r in by[shard]) - total / shards) <= largest


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_documents(documents, partitions):
    df, source = documents
    check(byte_shards(df, partitions=partitions).collect(), source, 16)


def test_same_on_any_partitioning(documents):
    df, _ = documents
    one, two = (Counter(map(tuple, byte_shards(d).collect())) for d in (df, df.repartition(7)))
    assert one == two


def test_edges(edges):
    check(byte_shards(edges, shards=3, partitions=4).collect(), EDGES, 3)


def test_one_key_for_most_rows(spark):
    df = spark.range(5000).selectExpr("if(id % 10 < 9, 5, id) AS doc_id", "'text' AS text")
    check(byte_shards(df, partitions=8).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], 16)


def test_parts_grow_with_the_rows(documents, monkeypatch):
    df, source = documents
    monkeypatch.setattr(sharding, "LEAST_PARTS", 1)
    check(byte_shards(df, rows_per_part=7).collect(), source, 16)


def test_empty_and_wrong(edges):
    assert byte_shards(edges.limit(0)).collect() == []
    with pytest.raises(ValueError):
        byte_shards(edges, shards=0)
