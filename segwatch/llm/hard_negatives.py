"""Hard negatives by exact scores from subset-sum tables (the Four Russians' way of multiplying).

The components are whole numbers. A candidate is kept as bit planes: for each power of two and each group of eight
dimensions, one byte with the bit that each of the eight components has there. An anchor is kept as a table for each
group: entry b is the sum of its components in the dimensions whose bits are set in b. A score is then read from the
tables, without products: for each plane, highest first, double what there is and add the groups' entries at
the candidates' bytes. The highest plane holds the signs and counts as negative.

Blocks of anchors meet blocks of candidates twice. First each anchor finds its positives, the best rows with its own
label. Their scores then say which scores of other labels are wanted, and the second meeting takes those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segwatch.functions.storage import cut

CANDIDATE_BLOCK = 4_096
ANCHOR_BLOCK = 1_024
GROUP = 8  # dimensions that share a table of 2**8 sums
MOST_PARTS = 4_096
SCALE = 256
LARGEST_LONG = 2**63 - 1

_BLOCK = "size int, block int, n array<bigint>, id array<bigint>, label array<bigint>, width int, planes binary"
_FOUND = "place bigint, anchor_id bigint, vec_id bigint, score bigint"
_NEGATIVES = "place bigint, anchor_id bigint, positive int, vec_id bigint, score bigint"


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components times ``scale``, rounded down, as doubles; NULL for a vector that cannot take part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def down(x: Column) -> Column:
        scaled = x.cast("double") * scale
        # Doubles from 2^52 on are whole already, and from 2^63 on `floor` would not hold them.
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.when(F.coalesce(good, F.lit(False)), F.transform(vector, down))


def planes_of(rows: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of bit planes and the packed bytes, ``planes x groups x rows``, of whole numbers.

    The last plane holds the signs (two's complement). Numbers of any size have as many planes as they need.
    """
    n, d = rows.shape
    most = int(max(rows.max(initial=0), -1 - rows.min(initial=0)))
    width = most.bit_length() + 1
    padded = np.zeros((n, -(-max(d, 1) // GROUP) * GROUP), dtype=rows.dtype)
    padded[:, :d] = rows
    out = np.empty((width, padded.shape[1] // GROUP, n), dtype="uint8")
    for plane in range(width):
        bits = ((padded >> plane) & 1).astype("uint8")
        out[plane] = np.packbits(bits, axis=1, bitorder="little").T
    return width, out


def numbers_of(width: int, planes: np.ndarray, d: int) -> np.ndarray:
    """The whole numbers back from their planes, rows x ``d``."""
    kind = "int64" if width <= 63 else object
    out = np.zeros((planes.shape[2], planes.shape[1] * GROUP), dtype=kind)
    for plane in range(width):
        bits = np.unpackbits(np.ascontiguousarray(planes[plane].T), axis=1, bitorder="little").astype(kind)
        out += bits * ((-1 if plane == width - 1 else 1) << plane)
    return out[:, :d]


def subset_sums(anchor: np.ndarray) -> np.ndarray:
    """A table of 256 sums for each group of eight components, each entry one addition to an earlier one."""
    groups = -(-max(len(anchor), 1) // GROUP)
    padded = np.zeros(groups * GROUP, dtype=anchor.dtype)
    padded[:len(anchor)] = anchor
    table = np.zeros((groups, 1 << GROUP), dtype=anchor.dtype)
    for bit in range(GROUP):
        table[:, 1 << bit:2 << bit] = table[:, :1 << bit] + padded.reshape(groups, GROUP)[:, bit, None]
    return table


def lookup_scores(table: np.ndarray, width: int, planes: np.ndarray) -> np.ndarray:
    """Exact inner products of one anchor with all rows of a block: shift, look up, add."""
    score = np.zeros(planes.shape[2], dtype=table.dtype)
    for plane in range(width - 1, -1, -1):
        here = table[0].take(planes[plane, 0])
        for group in range(1, len(table)):
            here += table[group].take(planes[plane, group])
        score = score * 2 + here if plane < width - 1 else -here
    return score


class Block:
    """Rows of one block with their planes, as they come from the packed table."""

    def __init__(self, table: pa.Table):
        row = {c: table.column(c)[0] for c in table.column_names}
        take = lambda c: row[c].values.to_numpy(zero_copy_only=False)
        self.n, self.id, self.label = take("n"), take("id"), take("label")
        self.size, self.width = row["size"].as_py(), row["width"].as_py()
        groups = -(-max(self.size, 1) // GROUP)
        self.planes = np.frombuffer(row["planes"].as_buffer(), dtype="uint8").reshape(self.width, groups, len(self.n))
        self.row = row

    def numbers(self) -> np.ndarray:
        return numbers_of(self.width, self.planes, self.size)


def _scores(anchors: Block, rows: Block) -> Iterator[tuple[int, np.ndarray]]:
    """For each anchor its place in the block and all scores; beyond 63 bits as Python's numbers."""
    numbers = anchors.numbers()
    bits = anchors.width + rows.width + anchors.size.bit_length()
    numbers = numbers.astype("int32" if bits < 31 else "int64" if bits < 63 else object)
    for i in range(len(numbers)):
        yield i, lookup_scores(subset_sums(numbers[i]), rows.width, rows.planes)


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    if len(score) > 4 * k and score.dtype != object:  # everything below the k-th highest can go at once
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.array(sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))[:k], dtype="int64")


def _fits(score: list[int]) -> list[int]:
    if any(not -LARGEST_LONG - 1 <= s <= LARGEST_LONG for s in score):
        raise ArithmeticError("a score does not fit a bigint")
    return score


def _table(columns: dict[str, list], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(columns.items(), kinds)})


def _positives(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"place": [], "anchor_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            anchors, rows = Block(left), Block(right)
            for i, score in _scores(anchors, rows):
                own = np.flatnonzero((rows.label == anchors.label[i]) & (rows.id != anchors.id[i]))
                best = own[_first(score[own], rows.id[own], k)]
                out["place"] += [int(anchors.n[i])] * len(best)
                out["anchor_id"] += [int(anchors.id[i])] * len(best)
                out["vec_id"] += rows.id[best].tolist()
                out["score"] += _fits([int(s) for s in score[best]])
        return _table(out, [pa.int64()] * 4)

    return run


def _negatives(k: int, low: int, high: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"place": [], "anchor_id": [], "positive": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            anchors, rows = Block(left), Block(right)
            wanted = dict(zip(left.column("asked")[0].as_py(), left.column("scores")[0].as_py()))
            for i, score in _scores(anchors, rows):
                positives = [int(s) for s in wanted.get(int(anchors.n[i]), ())]
                if not positives:
                    continue
                # Python's whole numbers, as a hundred times a score may not fit 64 bits: 100 s >= low p.
                bounds = [(-(-low * p // 100), high * p // 100) for p in positives]
                some = np.flatnonzero(
                    (rows.label != anchors.label[i]) & (score >= min(b[0] for b in bounds)) & (score <= max(b[1] for b in bounds))
                )
                some = some[_first(score[some], rows.id[some], len(some))]
                falling = [int(s) for s in score[some]]
                for p, (least, most) in enumerate(bounds):
                    # The first of the falling scores that is not above the positive's own range.
                    begin = int(np.searchsorted([-s for s in falling], -most)) if falling else 0
                    best = [j for j in range(begin, min(begin + k, len(falling))) if falling[j] >= least]
                    out["place"] += [int(anchors.n[i])] * len(best)
                    out["anchor_id"] += [int(anchors.id[i])] * len(best)
                    out["positive"] += [p + 1] * len(best)
                    out["vec_id"] += rows.id[some[best]].tolist() if best else []
                    out["score"] += _fits([falling[j] for j in best])
        return _table(out, [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])

    return run


def _pack(table: pa.Table) -> pa.Table:
    """The rows of one block as one row."""
    size, block = table.column("size")[0].as_py(), table.column("block")[0].as_py()
    flat = table.column("v").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(table.num_rows, size)
    if np.abs(flat).max(initial=0) < 2.0**62:
        numbers = flat.astype("int64")
    else:
        numbers = np.array([[int(x) for x in row] for row in flat.tolist()], dtype=object).reshape(flat.shape)
    width, planes = planes_of(numbers)
    columns = {"size": [size], "block": [block], **{c: [table.column(c).to_pylist()] for c in ("n", "id", "label")},
               "width": [width], "planes": [planes.tobytes()]}
    longs = pa.list_(pa.int64())
    return _table(columns, [pa.int32(), pa.int32(), longs, longs, longs, pa.int32(), pa.binary()])


def _blocks(rows: DataFrame, per_block: int, name: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows dealt to blocks of about ``per_block`` rows by their number, and packed. Vectors of different length, and
    rare ones with numbers beyond 32 bits, which need many planes, are in blocks of their own. Returned are each
    row's block, the packed blocks and their number."""
    counts = rows.agg(F.count_if(~F.col("large")).alias("usual"), F.count_if("large").alias("large")).head()
    usual, large = -(-counts["usual"] // per_block), -(-counts["large"] // per_block)
    mix = F.xxhash64("n")
    block = F.when(F.col("large"), F.pmod(mix, F.lit(max(1, large))) + usual).otherwise(F.pmod(mix, F.lit(max(1, usual))))
    dealt = cut(rows.withColumn("block", block.cast("int")).drop("large"), f"{name}-rows")
    packed = cut(dealt.groupBy("size", "block").applyInArrow(_pack, _BLOCK), name)
    return dealt.select(F.col("n").alias("place"), "size", "block"), packed, max(1, usual + large)


def hard_negatives(
    df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    candidate_block: int = CANDIDATE_BLOCK, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor is a row for which ``anchors`` holds. Its positives are the ``positives`` best other rows with its
    label. For each of them come the ``negatives`` best rows of other labels whose score lies between ``low`` and
    ``high`` percent of the positive's. Ties go to the smaller key; fewer rows give all of them.

    Rows without key or label, and vectors that are NULL or hold NULL, NaN or infinite components take no part.
    Rows with the anchor's key are not its positives; beyond that repeated rows and keys are candidates, and
    repeated anchors ask, each for itself. Vectors of different length never meet. Numbers of any size are
    exact; a returned score that does not fit a bigint fails the job. An empty table, a table without anchors or
    with one label only gives no rows. Other columns are not read.

    Every pair of blocks is one task input of bounded size, and yields a bounded number of rows an anchor. Work and
    shuffle are anchors x rows / block size by nature. Labels and vectors with most of the rows make no block larger.
    """
    tag = F.col(label) if isinstance(label, str) else label
    rows = df.select(
        F.col(key).cast("bigint").alias("id"), tag.cast("bigint").alias("label"), whole(F.col(vector)).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("n"),
    ).where("id is not null and label is not null and v is not null").withColumns({
        "size": F.size("v"), "large": F.exists("v", lambda x: F.abs(x) >= 2.0**31),
    })
    rows = cut(rows, "vectors")  # `n` tells rows apart and must stay
    _, given, n_rows = _blocks(rows.drop("asks"), candidate_block, "candidate-planes")
    asked, asking, n_anchors = _blocks(rows.where("asks").drop("asks"), anchor_block, "anchor-planes")

    def met(left: DataFrame, run, schema: str) -> DataFrame:
        left = left.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
        right = given.withColumnRenamed("block", "cb").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))
        pair = ["size", "block", "cb"]
        # Pairs are small and take long, so they are dealt by their number and not by their bytes.
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(n_rows * n_anchors, MOST_PARTS))
        left, right = left.repartition(parts, *pair), right.repartition(parts, *pair)
        return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(run, schema)

    best = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    first = met(asking, _positives(positives), _FOUND).withColumn("positive", F.row_number().over(best))
    first = cut(first.where(F.col("positive") <= positives), "positives")
    # At most a block of anchors with their positives to a row.
    by_anchor = first.groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("positive", "score"))), lambda s: s["score"]).alias("scores"))
    wanted = asked.join(by_anchor, "place").groupBy("size", "block").agg(F.collect_list(F.struct("place", "scores")).alias("w"))
    wanted = wanted.select("size", "block", F.col("w.place").alias("asked"), F.col("w.scores").alias("scores"))
    second = met(asking.join(wanted, ["size", "block"]), _negatives(negatives, low, high), _NEGATIVES)
    ranked = Window.partitionBy("place", "positive").orderBy(F.desc("score"), "vec_id")
    second = second.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    chosen = first.select("place", F.col("positive").cast("int").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return second.join(chosen, ["place", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
