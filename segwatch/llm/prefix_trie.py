"""The trie of the prefixes that conversations share, from vertical bitmaps.

Conversations are dealt by ranges of their number into shards of bounded size. A shard keeps, for each position and
turn, the set of its conversations with that turn there as the bits of a number (a posting). A node of the trie is
such a set too: its children are the non-empty intersections with the postings of the next position, its members
are counted by their bits, and depth-first descent from the root finds every node of the shard. Nodes are named by a
digest along their path, so what the shards found is put together by groups over the whole table.

What is alone from some turn on needs no search: where a turn at a position belongs to one conversation only, the path from
there on is a chain that is written straight from the turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segwatch.functions.storage import cut

SHARD_WIDTH = 2_000  # conversation numbers of a shard
FAMILY = 100  # conversations that share the opening of one of them
OPENING = 6  # openings have fewer turns than this
BAND = 64  # positions of a shard held at once
ROWS_PER_PART = 1 << 20
ROOT = b""
_NODES = (
    "shard bigint, path binary, parent binary, depth bigint, chars bigint, members array<bigint>, ends string, n_ends bigint, "
    "tails array<bigint>"
)


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart: the role's length keeps role and text from running together."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def running_sum(df: DataFrame, by: str, order: Sequence[str], value: Column, name: str, parts: int) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group up to and with this one; a large group lies in many parts.

    Rows are dealt by ranges of group and order, so only the first group of a part can have earlier rows
    elsewhere: at most one offset for each part is broadcast.
    """
    dealt = df.repartitionByRange(parts, by, *order).withColumns({"__part": F.spark_partition_id(), "__value": value})
    dealt = cut(dealt, "dealt")
    before = Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(by, "__part").agg(F.sum("__value").alias("__total"))
    offsets = totals.withColumn("__before", F.sum("__total").over(before)).where("__before is not null").drop("__total")
    inside = Window.partitionBy("__part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn(name, F.sum("__value").over(inside)).join(F.broadcast(offsets), [by, "__part"], "left")
    return summed.withColumn(name, F.col(name) + F.coalesce("__before", F.lit(0))).drop("__part", "__value", "__before")


class Shard:
    """One shard's members, the postings of the positions at hand, and the nodes whose children are to be found."""

    def __init__(self, number: int):
        self.number = number
        self.conversations: list[int] = []  # ascending; a conversation's place is its bit
        self.bit: dict[int, int] = {}
        self.ends: dict[int, int] = {}  # by depth: those that end there
        self.tails: dict[int, int] = {}  # by depth: those that go on alone from there
        self.last = 0  # depth of the last position at hand
        self.clear()
        self.frontier: list[tuple[int, bytes, int]] | None = None

    def clear(self) -> None:
        self.postings: dict[tuple[int, bytes], int] = {}
        self.turn: dict[tuple[int, int], bytes] = {}  # by depth and bit
        self.present: dict[int, int] = {}
        self.chars: dict[bytes, int] = {}

    def add_conversation(self, conversation: int, turns: int, alone: int) -> None:
        """It has ``turns`` turns, and from the position ``alone`` on no other conversation has its turn."""
        place = self.bit[conversation] = len(self.conversations)
        self.conversations.append(conversation)
        where, depth = (self.ends, turns) if turns < alone else (self.tails, alone - 1)
        where[depth] = where.get(depth, 0) | 1 << place

    def add_turn(self, depth: int, conversation: int, key: bytes, chars: int) -> None:
        place = self.bit[conversation]
        self.postings[depth, key] = self.postings.get((depth, key), 0) | 1 << place
        self.present[depth] = self.present.get(depth, 0) | 1 << place
        self.turn[depth, place] = key
        self.chars[key] = chars
        self.last = depth

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.conversations[low.bit_length() - 1])
            bits ^= low
        return out

    def _node(self, bits: int, path: bytes, parent: bytes | None, depth: int, chars: int) -> tuple:
        ends, tails = bits & self.ends.get(depth, 0), bits & self.tails.get(depth, 0)
        return (self.number, path, parent, depth, chars, self.members(bits), ",".join(map(str, self.members(ends))),
                ends.bit_count(), self.members(tails))

    def descend(self) -> Iterator[tuple]:
        """All nodes of the positions at hand, depth first; then these positions are forgotten."""
        if self.frontier is None:
            everyone = (1 << len(self.conversations)) - 1
            yield self._node(everyone, ROOT, None, 0, 0)
            self.frontier = [(everyone, ROOT, 0)]
        stack, self.frontier = self.frontier, []
        while stack:
            bits, path, depth = stack.pop()
            left = bits & self.present.get(depth + 1, 0)
            while left:
                key = self.turn[depth + 1, (left & -left).bit_length() - 1]
                child = bits & self.postings[depth + 1, key]
                left &= ~child
                below = hashlib.sha256(path + key).digest()[:16]
                yield self._node(child, below, path, depth + 1, self.chars[key])
                (stack if depth + 1 < self.last else self.frontier).append((child, below, depth + 1))
        self.clear()


def _search(band: int):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.int64(),
                 pa.list_(pa.int64()))
        names = [c.split(" ")[0] for c in _NODES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shard: Shard | None = None
        for rows in batches:
            for number, depth, conversation, key, chars, turns, alone in zip(*(c.to_pylist() for c in rows.columns)):
                if shard is None or number != shard.number:
                    if shard is not None:
                        yield from shard.descend()
                    shard = Shard(number)
                if depth == 0:
                    shard.add_conversation(conversation, turns, alone)
                    continue
                if depth != shard.last and shard.last and shard.last % band == 0:
                    yield from shard.descend()
                shard.add_turn(depth, conversation, key, chars)
        if shard is not None:
            yield from shard.descend()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for node in nodes(batches):
            held.append(node)
            size += 1 + len(node[5])
            if size > 1 << 17:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of the same path follow each other in the order of their numbers; each is read once and let go."""
    path, state = None, None
    for batch in batches:
        paths, digests = [], []
        for p, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if p != path:
                if state is not None:
                    paths.append(path)
                    digests.append(state.hexdigest())
                path, state = p, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(digests, pa.string())], names=["path", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([state.hexdigest()])], names=["path", "ends_sha256"])


def rebuilt_conversations(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    family: int = FAMILY, opening: int = OPENING, parts: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """``conv, d, turn_key, chars`` for every turn of the rebuilt conversations, and ``conv, turns`` for each of them.

    A conversation c opens with the first h turns of c - c % ``family``, where h is the checksum of its decimal number
    modulo ``opening``, and goes on with its own turns after its first h.
    """
    body, speaker = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    turns = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv"), F.col(turn).alias("turn"), turn_key(speaker, body).alias("turn_key"),
        F.length(body).cast("bigint").alias("chars"),
    )
    numbered = cut(running_sum(turns, "conv", ["turn", "turn_key"], F.lit(1), "p", parts).drop("turn"), "numbered")
    sizes = numbered.groupBy("conv").agg(F.max("p").alias("own")).withColumns({
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % opening, "head": F.col("conv") - F.col("conv") % family,
    })
    sizes = cut(sizes, "sizes")
    heads = sizes.select(F.col("conv").alias("head"), F.col("own").alias("head_turns"))
    info = sizes.join(heads, "head", "left").withColumn(
        "borrowed", F.least("h", F.coalesce("head_turns", F.lit(0)))
    ).select("conv", "head", "h", "borrowed", (F.col("borrowed") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("turns"))
    info = cut(info, "rebuilt-sizes")
    openings = numbered.where((F.col("conv") % family == 0) & (F.col("p") < opening)).withColumnRenamed("conv", "head")
    first = info.join(openings, "head").where(F.col("p") <= F.col("borrowed")).select("conv", F.col("p").alias("d"), "turn_key", "chars")
    own = numbered.join(info, "conv").where(F.col("p") > F.col("h")).select(
        "conv", (F.col("p") - F.col("h") + F.col("borrowed")).alias("d"), "turn_key", "chars"
    )
    return cut(first.unionByName(own), "rebuilt"), info.select("conv", "turns")


def prefix_trie(rows: DataFrame, conversations: DataFrame, shard_width: int = SHARD_WIDTH, band: int = BAND, parts: int = 8) -> DataFrame:
    """The nodes of the trie of ``rows`` (``conv, d, turn_key, chars``, d from 1 without gaps).

    ``conversations`` has ``conv, turns`` for every conversation, those without turns included. Returned are
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` for each node.

    A shard holds at most 2 * ``shard_width`` conversations and ``band`` positions of them at once, whatever is shared. Sums
    over subtrees need no walk upwards: every node is owned by its smallest member, the nodes a conversation owns
    are the lower end of its path, so a subtree's sum is the sum over its members of what they own, less what
    the smallest member owns above. These sums combine before they are shuffled, joins read files so that Spark
    can split a path or conversation with many rows, and the list of a node's ends is hashed as a stream.
    """
    spark = rows.sparkSession
    empty = hashlib.sha256(b"").hexdigest()
    postings = rows.groupBy("d", "turn_key").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    alone = postings.where("n = 1").groupBy("conv").agg(F.min("d").alias("alone"))
    info = cut(conversations.join(alone, "conv", "left").withColumn("alone", F.coalesce("alone", F.col("turns") + 1)), "shared-sizes")
    known = cut(rows.join(info, "conv"), "rebuilt-known")

    shard = F.expr(f"conv div {shard_width}").alias("shard")
    nothing = [F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("bigint").alias("chars")]
    headers = info.select(shard, F.lit(0).cast("bigint").alias("d"), "conv", *nothing, "turns", "alone")
    shared = known.where("d < alone").select(shard, F.col("d").cast("bigint").alias("d"), "conv", "turn_key", "chars", "turns", "alone")
    found = headers.unionByName(shared).repartition("shard").sortWithinPartitions("shard", "d", "conv").mapInArrow(_search(band), _NODES)
    found = cut(found, "shard-nodes")

    merged = found.groupBy("path").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
        F.sum(F.size("members")).alias("n_convs"), F.min(F.element_at("members", 1)).alias("conv_id"),
        F.sum(F.size("tails")).alias("n_tails"), F.sum("n_ends").alias("n_ends"),
    )
    merged = cut(merged, "nodes")
    below = merged.groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_below"))
    nodes = merged.join(below, "path", "left").withColumns({
        "n_children": F.col("n_tails") + F.coalesce("n_below", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("chars"),
    }).select("path", "parent", "depth", "n_convs", "conv_id", "n_children", "saved")
    nodes = cut(running_sum(nodes, "conv_id", ["depth"], F.col("saved"), "saved_upto", parts), "nodes-owned")

    owned = nodes.select(F.col("conv_id").alias("conv"), "saved", (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    lone = found.select(F.explode("tails").alias("conv"), F.col("path").alias("parent")).join(info, "conv")
    lone = cut(lone, "lone-tails")
    leaves = lone.select("conv", F.lit(0).cast("bigint").alias("saved"), F.lit(1).cast("bigint").alias("leaf"))
    totals = owned.unionByName(leaves).groupBy("conv").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    totals = cut(totals.where("saved > 0 or leaf > 0"), "owned-totals")
    inside = found.select("path", F.explode("members").alias("conv")).join(totals, "conv").groupBy("path").agg(
        F.sum("saved").alias("saved_inside"), F.sum("leaf").alias("n_leaves")
    )
    lists = found.where("n_ends > 0").select("path", "shard", "ends").repartition("path").sortWithinPartitions("path", "shard")
    ends = lists.mapInArrow(_hash_ends, "path binary, ends_sha256 string")
    above = merged.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.join(inside, "path", "left").join(ends, "path", "left").join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("saved_inside", F.lit(0)) - F.col("saved_upto") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )

    def chain(df: DataFrame, depth: Column, parent: Column) -> DataFrame:
        ends_here = depth == F.col("turns")
        own = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
        return df.select(
            F.col("conv").alias("conv_id"), depth.cast("bigint").alias("depth"), parent.alias("parent_conv_id"),
            F.lit(1).cast("bigint").alias("n_convs"), (~ends_here).cast("bigint").alias("n_children"),
            F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
            F.when(ends_here, own).otherwise(F.lit(empty)).alias("ends_sha256"),
        )

    starts = chain(lone.join(above, "parent"), F.col("alone"), F.col("parent_conv_id"))
    rest = chain(known.where("d > alone"), F.col("d"), F.col("conv"))
    return inner.unionByName(starts).unionByName(rest)


def conversation_trie(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    family: int = FAMILY, opening: int = OPENING, shard_width: int = SHARD_WIDTH, band: int = BAND,
) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``df``; see ``rebuilt_conversations`` and ``prefix_trie``.

    Turns go by number, NULL first, and turns of one number by the digest of role and text, so repeated rows are
    turns of their own that follow each other. NULL roles and texts count as empty, rows without conversation belong to
    none. Very long texts are hashed where they are read and not moved. A conversation of any number of turns is
    dealt over many tasks, but for the turns it shares with others, which its shard reads as a stream. An empty
    table has no nodes, not even a root. Other columns are not read.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_PART))
    rows, conversations = rebuilt_conversations(df, key, turn, role, text, family, opening, parts)
    return prefix_trie(rows, conversations, shard_width, band, parts)
