"""The prefix trie against a plain one that walks dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from segwatch.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id bigint, turn int, role string, text string, depth string, path int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def key_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0, key_of(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = tuple(own.get(head, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        own_saving = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own_saving
            leaves[p[:d]] += children[p] == 0
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def found(df, **options):
    return Counter(tuple(r[c] for c in COLUMNS) for r in conversation_trie(df, **options).select(*COLUMNS).collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)


def test_whole_table(spark, data):
    df = spark.read.parquet(data("0.001", "conversations"))
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert found(df) == plain(rows)


EDGES = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "hi"), (0, 2, "user", None), (0, 3, None, "long " * 50_000), (0, 4, "user", "e"), (0, 5, "user", "f"),
    (7, 0, "user", "hello"), (7, None, "user", "first"), (7, 0, "user", "hello"), (7, 0, "user", "a tie"), (8, 0, "", ""), (8, 0, "", ""),
    (199, 0, "user", "no head"), (198, 0, "user", "no head"), (-5, 0, "user", "hello"), (-100, 0, "user", "hello"), (-101, 3, "u", "serhello"),
    (None, 0, "user", "nobody's"), (5_000_000_000, 1, "user", "hello"), (5_000_000_000, 1, None, None),
]


def test_edges(spark):
    assert found(table(spark, EDGES), shard_width=100, band=1) == plain(EDGES)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == Counter()


def test_random_conversations_over_many_shards(spark):
    draw = random.Random(5)
    rows = [
        (c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "ccc"]))
        for c in range(-150, 900) for t in range(draw.randint(0, 9)) if c % 3
    ]
    assert found(table(spark, rows), shard_width=100, band=3) == plain(rows)


def test_a_hot_long_conversation_and_its_copies(spark):
    """One conversation has most rows, is copied, and its end is shared by many: no shard is too small for that."""
    long = [(c, t, "user", f"turn {t}") for c in (600, 601, 602) for t in range(1500)]
    copies = [(c, t, "user", f"turn {t}") for c in range(1000, 1600) for t in range(7)]
    assert found(table(spark, long + copies), shard_width=100, band=16) == plain(long + copies)
