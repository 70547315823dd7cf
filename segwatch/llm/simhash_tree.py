"""Near duplicates by SimHash: fingerprints dealt by a vantage-point tree, exact pairs, components.

A node of the tree has a fingerprint as its pivot and a radius. Fingerprints at most the radius away
live in the near half, the others in the far half. By the triangle inequality a pair at distance r has
distances to the pivot that differ by r at most, so a pair that the node parts has its far member within
r beyond the radius: that member also visits the near half. Each leaf is a shard; in it, residents are compared
with residents and visitors, by going on with the same tree until few are left.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segwatch.functions.storage import cut

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
SHARD_ROWS = 8_192
PIVOT_SAMPLE = 65_536  # fingerprints that place pivots; they affect balance only, every fingerprint is indexed
SAMPLE_PER_SHARD = 64
COMPARED_AT_ONCE = 256
SMALL = 512


def fingerprint(text: str | None) -> int:
    """The 64 majority bits of the hashes of all word shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), dtype="uint64")
    votes = np.zeros(64, dtype="int64")
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype="int64")
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("uint64")[0])


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` (bigint, the 64 bits as a signed number) in place of the column ``text``."""
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(len(kept)).to_pylist()], dtype="uint64")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view("int64"))], names=[*kept, "fingerprint"])

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in kept)
    return df.select(*kept, text).mapInArrow(run, f"{schema}fingerprint bigint")


def _distance(values: np.ndarray, pivot: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ pivot)


def _split(values: np.ndarray) -> tuple[np.uint64, int] | None:
    """A pivot and radius that part ``values`` evenly, with few of them just beyond the radius."""
    best = None
    for pivot in values[:: max(1, len(values) // 4)][:4]:
        counts = np.bincount(_distance(values, pivot), minlength=65)
        upto = np.cumsum(counts)
        radius = int(np.searchsorted(upto, len(values) / 2))
        if upto[radius] == len(values):
            radius -= 1
        if radius < 0 or not 0 < upto[radius] < len(values):
            continue
        cost = upto[min(64, radius + RADIUS)] - upto[radius] + abs(2 * upto[radius] - len(values)) / 2
        if best is None or cost < best[0]:
            best = cost, pivot, radius
    return best[1:] if best else None


def grow_tree(sample: np.ndarray, shards: int) -> list[tuple]:
    """Nodes ``(pivot, radius, near, far)``; children are node numbers, or shards as -1 - number."""
    nodes: list[tuple] = []
    leaves = itertools.count()

    def grow(values: np.ndarray, wanted: int) -> int:
        parts = _split(values) if wanted > 1 and len(values) > 1 else None
        if parts is None:
            return -1 - next(leaves)
        pivot, radius = parts
        at = len(nodes)
        nodes.append(())
        near = _distance(values, pivot) <= radius
        share = max(1, min(wanted - 1, round(wanted * near.mean())))
        nodes[at] = (pivot, radius, grow(values[near], share), grow(values[~near], wanted - share))
        return at

    grow(sample, shards)
    return nodes


def deal(nodes: list[tuple], values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``shard, positions, resident`` of all values in every shard that they live in or have to visit."""
    todo = [(0 if nodes else -1, np.arange(len(values)), np.ones(len(values), dtype=bool))]
    while todo:
        at, who, home = todo.pop()
        if not len(who):
            continue
        if at < 0:
            yield -1 - at, who, home
            continue
        pivot, radius, near, far = nodes[at]
        d = _distance(values[who], pivot).astype("int16")
        inside = d <= radius
        # A resident beyond the radius only visits the near half; a visitor goes wherever a resident may be in reach.
        to_near = d <= radius + reach
        to_far = np.where(home, ~inside, d > radius - reach)
        todo.append((near, who[to_near], home[to_near] & inside[to_near]))
        todo.append((far, who[to_far], home[to_far]))


class Components:
    """Connected components of numbered points, by hooking to the smallest and halving paths."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if len(a):
                np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
                while True:
                    higher = self.root[self.root]
                    if (higher == self.root).all():
                        break
                    self.root = higher


def link_shard(values: np.ndarray, home: np.ndarray, reach: int) -> np.ndarray:
    """The smallest linked position for each value, over all links with at least one resident."""
    found = Components(len(values))
    todo = [(np.arange(len(values)), home)]
    while todo:
        who, here = todo.pop()
        residents = int(here.sum())
        if not residents or len(who) < 2:
            continue
        parts = _split(values[who[here]][:4096]) if residents > SMALL else None
        if parts is not None:
            pivot, radius = parts
            d = _distance(values[who], pivot).astype("int16")
            inside = d <= radius
            near = d <= radius + reach
            far = np.where(here, ~inside, d > radius - reach)
            if max(near.sum() * (here & inside).sum(), far.sum() * (here & ~inside).sum()) < len(who) * residents:
                todo.append((who[near], (here & inside)[near]))
                todo.append((who[far], here[far]))
                continue
        homes = who[here]
        for at in range(0, residents, COMPARED_AT_ONCE):
            some = homes[at:at + COMPARED_AT_ONCE]
            a, b = np.nonzero(np.bitwise_count(values[some][:, None] ^ values[who][None, :]) <= reach)
            found.link(some[a], who[b])
    return found.root


def linked_fingerprints(distinct: DataFrame, rows: int, reach: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fingerprint``) that connect what is in reach.

    Not every pair is returned, but a spanning forest of the pairs in each shard.
    """
    shards = max(1, -(-rows // shard_rows))
    wanted = min(PIVOT_SAMPLE, shards * SAMPLE_PER_SHARD)
    sample = [r[0] for r in distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(wanted).collect()] if shards > 1 else []
    nodes = grow_tree(np.array(sample, dtype="int64").view("uint64"), shards)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view("uint64")
            for shard, who, home in deal(nodes, values, reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(who), shard)), pa.array(values[who].view("int64")), pa.array(home)], names=["shard", "value", "home"]
                )

    def connect(part: pd.DataFrame) -> pd.DataFrame:
        values = part["value"].to_numpy().view("uint64")
        root = link_shard(values, part["home"].to_numpy(), reach)
        moved = root != np.arange(len(root))
        return pd.DataFrame({"a": values[root[moved]].view("int64"), "b": values[moved].view("int64")})

    placed = distinct.select("fingerprint").mapInArrow(place, "shard bigint, value bigint, home boolean")
    return placed.groupBy("shard").applyInPandas(connect, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``): the smallest node it is connected with.

    Large and small stars in turn: every node sends its larger neighbours, then its smaller ones, to its
    smallest neighbour. Rounds grow with the logarithm of the longest chain, each round is two
    aggregates that combine before the shuffle, and each is written to the shared folder.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).head()
        if (state["n"], state["s"]) == seen or not state["n"]:
            break
        seen = (state["n"], state["s"])
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("m", "a").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(smallest, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(smallest.select("u", "m"))
        edges = cut(small.where("a <> b").distinct(), "links")
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", reach: int = RADIUS, shard_rows: int = SHARD_ROWS, carry: Sequence[str] = ()
) -> DataFrame:
    """``key, fingerprint, component_id, root``: one row for each row of ``df``.

    ``fingerprint`` is 16 hexadecimal digits; ``component_id`` is the smallest key reachable over fingerprints
    that differ in ``reach`` bits or fewer; ``root`` is one fingerprint (bigint) of the component. Columns named in
    ``carry`` come along as the struct ``carried``. Equal fingerprints are one point of the tree, so copies in any
    number cost one comparison. NULL and empty texts and texts without words share fingerprint 0, which links like any
    other. A NULL key is the smallest only where its component has no other. Repeated rows and keys are
    kept, an empty table gives an empty result, and other columns are not read.
    """
    carried = [F.struct(*(F.col(c) for c in carry)).alias("carried")] if carry else []
    marked = cut(fingerprints(df.select(F.col(key).alias("key"), *carried, F.col(text).alias("text"))), "fingerprints")
    distinct = cut(marked.groupBy("fingerprint").agg(F.min("key").alias("first")), "distinct-fingerprints")
    roots = cut(components(linked_fingerprints(distinct, distinct.count(), reach, shard_rows)), "roots")
    of_root = roots.join(distinct, roots.node == distinct.fingerprint).groupBy("root").agg(F.min("first").alias("component"))
    linked = roots.join(of_root, "root").select(F.col("node").alias("fingerprint"), "component", "root")
    # Written, so that Spark can split a fingerprint that many rows have in the last join.
    of_print = cut(distinct.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "first").alias("component"), F.coalesce("root", "fingerprint").alias("root")
    ), "components")
    return marked.join(of_print, "fingerprint").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"), "root", *(["carried"] if carry else []),
    )
