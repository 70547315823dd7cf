"""Nearest centroids by an index, for centroids too many to ship with every task.

The centroids are a table. Some of them, drawn by hash, are pivots; each centroid belongs to the ball of its nearest pivot, and
balls with many centroids are cut into parts. Only the balls travel with the tasks: centre, radius and one
centroid of each. A row is no nearer to a ball's centroids than to its centre less the radius, so it has to be compared
with the balls for which this is not beyond the nearest of those single centroids. Rows meet balls in blocks
of bounded size, and the best of a row's comparisons is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segwatch.functions.distance import nearest
from segwatch.functions.storage import cut

LEAF_ROWS = 1_024  # centroids of a ball
GROUP_ROWS = 8_192  # rows that meet a ball at once
NO_CLUSTER = np.iinfo("int64").max
CELLS = 1 << 22  # distances to balls held at once
SLACK = 1e-9  # of the sizes involved: beyond the rounding error of a distance


@dataclass(frozen=True)
class CentroidIndex:
    """The balls, and the table of their centroids: ``ball, clusters, body`` with one row for each ball."""

    leaves: DataFrame
    centres: np.ndarray
    radii: np.ndarray
    members: np.ndarray  # one centroid of each ball

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the balls that may hold their nearest centroid."""
        rows, balls = [], []
        for at in range(0, len(x), step := max(1, CELLS // len(self.centres))):
            part = x[at:at + step]
            size = np.sqrt((part * part).sum(axis=1))[:, None]
            bar = _distances(part, self.members).min(axis=1)[:, None]
            low = _distances(part, self.centres) - self.radii
            # Squares of distances are off by a part of the squared sizes, so small distances by its root.
            r, b = np.nonzero(low <= bar + math.sqrt(SLACK) * 1e-2 * (size + self.scale()))
            rows.append(r + at)
            balls.append(b)
        return np.concatenate(rows), np.concatenate(balls)

    def scale(self) -> float:
        return float(np.sqrt((self.centres**2).sum(axis=1)).max() + self.radii.max())


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2.0 * (x @ points.T)
    return np.sqrt(np.maximum(squared, 0.0))


def build_index(centroids: DataFrame, features: Sequence[str], limit: int, place) -> CentroidIndex:
    """An index of ``centroids``: ``cluster`` and the features. The balls have to fit into ``limit`` bytes.

    ``place(df, pivots)`` adds to a table with the features the number of the nearest pivot as ``pivot``. Centroids at the same
    place count once, under their smallest number.
    """
    width = len(features)
    distinct = cut(centroids.groupBy(*features).agg(F.min("cluster").alias("cluster")), "centroids")
    k = distinct.count()
    if k == 0:
        raise ValueError("centroids must be a non-empty list of points")
    wanted = math.isqrt(k - 1) + 1
    if wanted * (2 * width + 1) * 8 > limit:
        raise ValueError(f"{k} centroids of {width} features need an index of more than {limit} bytes")
    mix = F.xxhash64(*features)
    pivots = [list(r) for r in distinct.orderBy(mix, "cluster").limit(wanted).select(*features).collect()]
    placed = place(distinct, pivots)
    parts = placed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / LEAF_ROWS).alias("parts"))  # a row for each pivot
    dealt = placed.join(F.broadcast(parts), "pivot").withColumn("part", F.pmod(F.xxhash64("cluster"), F.col("parts")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("cluster")
        x = np.column_stack([table.column(f).to_numpy() for f in features])
        centre = x.mean(axis=0)
        away = np.sqrt(((x - centre) ** 2).sum(axis=1))
        one = x[away.argmin()]
        columns = {"pivot": table.column("pivot")[0].as_py(), "part": table.column("part")[0].as_py(), "centre": centre.tolist(),
                   "radius": float(away.max() * (1 + SLACK)), "member": one.tolist(), "clusters": table.column("cluster").to_pylist(), "body": x.tobytes()}
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.binary()]
        return pa.table({c: pa.array([v], kind) for (c, v), kind in zip(columns.items(), kinds)})

    schema = "pivot int, part int, centre array<double>, radius double, member array<double>, clusters array<bigint>, body binary"
    rows = dealt.select("pivot", "part", F.col("cluster").cast("bigint").alias("cluster"), *features)
    balls = cut(rows.groupBy("pivot", "part").applyInArrow(pack, schema), "balls")
    many = balls.count()
    if many * (2 * width + 1) * 8 > limit:
        raise ValueError(f"{many} balls of {width} features exceed {limit} bytes")
    listed = balls.select("pivot", "part", "centre", "radius", "member").orderBy("pivot", "part").collect()
    number = F.create_map(*(F.lit(x) for i, r in enumerate(listed) for x in (f"{r['pivot']}|{r['part']}", i)))
    leaves = balls.select(number[F.concat_ws("|", "pivot", "part")].alias("ball"), "clusters", "body")
    as_rows = lambda c: np.array([r[c] for r in listed], dtype="float64")
    return CentroidIndex(cut(leaves, "leaves"), as_rows("centre"), as_rows("radius"), as_rows("member"))


def search_index(index: CentroidIndex, rows: DataFrame) -> DataFrame:
    """``row, distance, cluster``: the nearest centroid of each row of ``rows`` (``row`` and ``x``, the features as an array).

    Rows are packed into blocks. Blocks and balls meet as a product of the two tables' partitions, which a task reads from their files,
    so no row is shuffled once for each of its balls; a block's best results, one for each partition of the balls, are.
    Squared distances are sums of plain differences; the smallest number wins a tie. Rows with a NULL array have no result.
    """
    width = index.centres.shape[1]
    balls = CentroidIndex(None, index.centres, index.radii, index.members)  # without the table, which does not travel

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_ROWS):
                part = batch.slice(at, GROUP_ROWS)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                r, b = balls.candidates(x)
                order = np.argsort(b, kind="stable")
                asks = np.column_stack([r[order], b[order]]).astype("int32")
                values = [part.column(0).to_numpy().astype("int64").tobytes(), x.tobytes(), asks.tobytes()]
                columns = [*(pa.array([v], pa.binary()) for v in values), pa.array([np.unique(b).astype("int32").tolist()], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["rows", "x", "asks", "wanted"])

    packed = rows.where(F.col("x").isNotNull()).select("row", "x").mapInArrow(wanted, "rows binary, x binary, asks binary, wanted array<int>")
    blocks = packed.withColumn("block", F.monotonically_increasing_id())
    leaves = index.leaves.select("ball", "clusters", "body").hint("shuffle_replicate_nl")
    pairs = blocks.join(leaves, F.array_contains("wanted", F.col("ball"))).select("block", "rows", "x", "asks", "ball", "clusters", "body")
    fields = "rows binary, distance binary, cluster binary"

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, None  # a block meets the balls of the task one after the other

        def done() -> pa.RecordBatch:
            columns = [pa.array([block], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in held)]
            return pa.RecordBatch.from_arrays(columns, names=["block", "rows", "distance", "cluster"])

        for batch in batches:
            for i, (number, ball) in enumerate(zip(batch.column(0).to_pylist(), batch.column(4).to_pylist())):
                if number != block:
                    if block is not None:
                        yield done()
                    block, x, asks = number, _values(batch.column(2)[i], "float64").reshape(-1, width), _values(batch.column(3)[i], "int32").reshape(-1, 2)
                    held = (_values(batch.column(1)[i], "int64"), np.full(len(x), np.inf), np.full(len(x), NO_CLUSTER))
                which = asks[slice(*np.searchsorted(asks[:, 1], [ball, ball + 1])), 0]
                points = _values(batch.column(6)[i], "float64").reshape(-1, width)
                at, squared = nearest(x[which], points)
                _keep_nearer(held, which, squared, batch.column(5)[i].values.to_numpy()[at])
        if block is not None:
            yield done()

    def merge(table: pa.Table) -> pa.Table:
        parts = [[_values(v, kind) for c in table.column(name).chunks for v in c] for name, kind in (("rows", "int64"), ("distance", "float64"), ("cluster", "int64"))]
        held = (parts[0][0], np.full(len(parts[0][0]), np.inf), np.full(len(parts[0][0]), NO_CLUSTER))
        for squared, cluster in zip(*parts[1:]):
            _keep_nearer(held, np.arange(len(squared)), squared, cluster)
        found = held[2] != NO_CLUSTER  # a row without finite distances has none
        return pa.table({c: v[found] for c, v in zip(("row", "distance", "cluster"), held)})

    met = pairs.mapInArrow(best, f"block bigint, {fields}")
    return met.groupBy("block").applyInArrow(merge, "row bigint, distance double, cluster bigint")


def _values(value: pa.BinaryScalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=kind)


def _keep_nearer(held: tuple[np.ndarray, ...], which: np.ndarray, squared: np.ndarray, cluster: np.ndarray) -> None:
    """Distance and number of the nearest so far of some rows of a block; the smaller number wins a tie."""
    _, distance, number = held
    nearer = (squared < distance[which]) | (squared == distance[which]) & (cluster < number[which])
    distance[which[nearer]], number[which[nearer]] = squared[nearer], cluster[nearer]


def assign_by_index(
    df: DataFrame, values: Sequence[Column], index: CentroidIndex, missing: Column, raises: bool, keep: Sequence[str], output: str, distance: str | None
) -> DataFrame:
    """``df`` with the number of the nearest centroid of ``index``, every other column as it is.

    The rows are written once, so that their numbers stay; results come back to them by a join on the number.
    """
    failure = F.raise_error(F.lit("cannot assign a row with missing features")).cast("array<double>")
    packed = F.when(missing, failure if raises else F.lit(None).cast("array<double>")).otherwise(F.array(*values))
    numbered = cut(df.select(*keep, packed.alias("__x"), F.monotonically_increasing_id().alias("__row")), "numbered")
    found = cut(search_index(index, numbered.select(F.col("__row").alias("row"), F.col("__x").alias("x"))), "nearest")
    added = [F.col("cluster").cast("int").alias(output)] + ([F.col("distance").alias(distance)] if distance else [])
    back = found.select(F.col("row").alias("__row"), F.col("cluster").alias("cluster"), F.col("distance").alias("distance"))
    clash = {c: f"__kept_{i}" for i, c in enumerate(keep)}  # the table may have columns of these names
    renamed = numbered.drop("__x").withColumnsRenamed(clash)
    joined = renamed.join(back, "__row", "left")
    return joined.select(*(F.col(n).alias(c) for c, n in clash.items()), *added)
