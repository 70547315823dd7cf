import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from conftest_llm import EDGES
from segwatch.llm import simhash_tree as tree


def plain_print(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Every pair of distinct fingerprints compared."""
    first = {}
    for i, f in rows:
        first[f] = min((x for x in (first.get(f), i) if x is not None), default=None)
    prints = sorted(first)
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for n, a in enumerate(prints):
        for b in prints[:n]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for f in prints:
        least[find(f)] = min((x for x in (least.get(find(f)), first[f]) if x is not None), default=None)
    return Counter((i, f"{f:016x}", least[find(f)]) for i, f in rows)


def result(df, **more):
    return Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in tree.near_duplicates(df, **more).collect())


@pytest.mark.parametrize("shard_rows", [8192, 20])
def test_documents(documents, shard_rows):
    df, rows = documents
    assert result(df, shard_rows=shard_rows) == plain_components([(i, plain_print(t)) for i, t in rows])


def test_edges(edges):
    assert result(edges) == plain_components([(i, plain_print(t)) for i, t in EDGES])
    assert result(edges.limit(0)) == Counter()


def _prints(n, seed):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        f = rng.getrandbits(64)
        out.append(f)
        for _ in range(rng.choice([0, 0, 3, 12])):
            for b in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << b
            out.append(f)
    return sorted(set(out[:n]))


@pytest.mark.parametrize(("shards", "seed"), [(1, 1), (5, 2), (40, 3), (200, 4)])
def test_no_pair_is_lost_whatever_the_tree(shards, seed):
    values = np.array(_prints(1500, seed), dtype="uint64")
    nodes = tree.grow_tree(values[::3], shards)
    found, homes = set(), Counter()
    for _, who, home in tree.deal(nodes, values, 3):
        homes.update(who[home].tolist())
        for a in who[home].tolist():
            near = np.bitwise_count(values[who] ^ values[a]) <= 3
            found.update((min(a, b), max(a, b)) for b in who[near].tolist() if a != b)
    assert homes == Counter(range(len(values)))  # every fingerprint lives in exactly one shard
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    assert found == {(a, b) for a, b in zip(*np.nonzero(close)) if a < b}


def test_links_inside_a_shard(monkeypatch):
    monkeypatch.setattr(tree, "SMALL", 16)
    values = np.array(_prints(1200, 9), dtype="uint64")
    home = np.arange(len(values)) % 4 != 0
    root = tree.link_shard(values, home, 3)
    expected = tree.Components(len(values))
    a, b = np.nonzero((np.bitwise_count(values[:, None] ^ values[None, :]) <= 3) & home[:, None])
    expected.link(a, b)
    assert (root == expected.root).all()


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i % 50] + [(7, 7), (3, 2), (2, 3)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in tree.components(edges).collect()}
    assert got == {i: (i - 1) // 50 * 50 + 1 for i in range(1, 201)}


def test_many_near_copies_are_one_component(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat(repeat('all these words are the same in every copy ', 60), id % 700) AS text")
    got = tree.near_duplicates(df, shard_rows=64)
    prints = got.select("fingerprint").distinct().count()
    assert prints >= 1 and {r["component_id"] for r in got.collect()} == {0}
