"""Nearest-centroid assignment, Lloyd iterations and the k-means fit."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segwatch.functions.columns import any_missing, as_double, is_missing, reject_missing, require_columns
from segwatch.functions.distance import nearest, squared_distance
from segwatch.functions.storage import cut, local_table
from segwatch.operators.blocks import BoundedLloyd, draw_seeds, pack_rows
from segwatch.operators.centroid_index import CentroidIndex, assign_by_index, build_index
from segwatch.operators.scaling import Scaler, column_moments

log = logging.getLogger(__name__)

# Distance terms (clusters x features) kept as generated JVM code. Beyond it one generated method
# would grow past what the JVM compiles, and Arrow batches with a matrix product are faster.
UNROLLED_TERMS = 128
# Size to which the centroids of all sets, shipped together inside each task, may grow.
CENTROID_BYTES = 64 << 20

Points = Sequence[Sequence[float]]


@dataclass(frozen=True)
class Clustering:
    """Fitted centroids in cluster order, with the sum of squared distances on the fitted table."""

    features: tuple[str, ...]
    centroids: tuple[tuple[float, ...], ...]
    inertia: float
    iterations: int

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, *map(float, c)) for i, c in enumerate(self.centroids)]
        names = ", ".join(f"`{f}` double" for f in self.features)
        return local_table(spark, rows, f"cluster int, {names}")


def _check_shape(points: Points, width: int) -> None:
    if not points or any(len(p) != width for p in points):
        raise ValueError(f"centroids must be a non-empty list of points with {width} coordinates")


def _check_points(points: Points, width: int) -> None:
    _check_shape(points, width)
    if len(points) * width * 8 > CENTROID_BYTES:
        raise ValueError(f"{len(points)} centroids of {width} features exceed {CENTROID_BYTES} bytes")


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return batch.to_numpy(dtype="float64", na_value=np.nan)


def _nearest_udf(points: Points, missing_fails: bool):
    fixed = np.asarray(points, dtype="float64")

    @F.pandas_udf("cluster int, distance double")
    def udf(rows: pd.DataFrame) -> pd.DataFrame:
        values = _matrix(rows)
        bad = np.isnan(values).any(axis=1)
        if missing_fails and bad.any():
            raise ValueError("cannot assign a row with missing features")
        cluster, distance = nearest(np.nan_to_num(values), fixed)
        return pd.DataFrame({
            "cluster": pd.Series(cluster, dtype="Int32").mask(bad),
            "distance": pd.Series(distance).mask(bad),
        })

    return udf


def assign(
    df: DataFrame,
    features: Sequence[str],
    centroids: Points | DataFrame,
    scaler: Scaler | None = None,
    output: str = "cluster",
    distance: str | None = None,
    missing: str = "raise",
    limit: int = CENTROID_BYTES,
) -> DataFrame:
    """Add the index of the nearest centroid; the lowest index wins a tie.

    A projection only: no shuffle, and every other column stays as it is. With ``scaler`` the
    distance is taken on the standardised values while the table keeps the original ones.
    ``distance`` names a column for the squared distance. Rows with a missing feature fail the job
    (``missing="raise"``) or get NULL (``missing="null"``).

    Centroids of more than ``limit`` bytes, or given as a table of ``cluster`` and the features, do not travel with the
    tasks: they are indexed as a table (see ``centroid_index``), which shuffles rows and numbers, with the same result.
    """
    require_columns(df, features)
    table = isinstance(centroids, DataFrame)
    if not table:
        _check_shape(centroids, len(features))
    if missing not in ("raise", "null"):
        raise ValueError("missing must be 'raise' or 'null'")
    values = [scaler.column(f) if scaler else as_double(f) for f in features]
    keep = [c for c in df.columns if c not in (output, distance)]
    if table or len(centroids) * len(features) * 8 > limit:
        index = index_centroids(centroids if table else _centroid_table(df.sparkSession, centroids, features), features, limit)
        return assign_by_index(df, values, index, any_missing(features), missing == "raise", keep, output, distance)
    if len(centroids) * len(features) > UNROLLED_TERMS:
        packed = F.struct(*(v.alias(f) for v, f in zip(values, features)))
        scored = df.withColumn("__nearest", _nearest_udf(centroids, missing == "raise")(packed))
    else:
        # One expression that names each distance once: a filter on the cluster, which the optimiser
        # moves below this projection, then repeats k distances and not k squared. Coalesced inputs
        # cannot be NULL, which spares the generated code a test per term.
        inputs = [F.coalesce(v, F.lit(0.0)) for v in values]
        options = [
            F.struct(squared_distance(inputs, c).alias("distance"), F.lit(j).alias("cluster"))
            for j, c in enumerate(centroids)
        ]
        if missing == "raise":
            failure = F.raise_error(F.lit("cannot assign a row with missing features"))
        else:
            failure = F.lit(None)
        best = F.array_min(F.array(*options))
        scored = df.withColumn(
            "__nearest",
            F.when(any_missing(features), failure.cast("struct<distance: double, cluster: int>")).otherwise(best),
        )
    cluster, squared = F.col("__nearest.cluster"), F.col("__nearest.distance")
    added = [cluster.cast("int").alias(output)]
    if distance:
        added.append(squared.alias(distance))
    return scored.select(*keep, *added)


def _centroid_table(spark: SparkSession, points: Points, features: Sequence[str]) -> DataFrame:
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return local_table(spark, rows, "cluster int, " + ", ".join(f"`{f}` double" for f in features))


def index_centroids(centroids: DataFrame, features: Sequence[str], limit: int = CENTROID_BYTES) -> CentroidIndex:
    """An index of a table of ``cluster`` and the features; its balls are held to ``limit`` bytes."""
    require_columns(centroids, ["cluster", *features])
    names = [f"x{i}" for i in range(len(features))]
    plain = reject_missing(centroids, features, "centroids").select("cluster", *(F.col(f).alias(n) for f, n in zip(features, names)))
    return build_index(plain, names, limit, lambda df, pivots: assign(df, names, pivots, output="pivot", limit=limit))


def _unrolled_sums(df: DataFrame, features: Sequence[str], points: Points) -> DataFrame:
    """The sums for one centroid set as generated code: distances first, then the choice among them."""
    inputs = df.select(*(as_double(f).alias(f"__x{i}") for i, f in enumerate(features)))
    values = [F.col(c) for c in inputs.columns]
    ds = [f"__d{j}" for j in range(len(points))]
    near = inputs.withColumns({d: squared_distance(values, c) for d, c in zip(ds, points)})
    least = F.least(*ds) if len(ds) > 1 else F.col(ds[0])
    near = near.withColumn("__least", least)
    failure = F.raise_error(F.lit("cannot assign a row with missing features"))
    choice = F.when(is_missing("__least"), failure.cast("int"))
    for j, d in enumerate(ds):
        choice = choice.when(F.col(d) == F.col("__least"), F.lit(j))
    return near.groupBy(F.lit(0).alias("start"), choice.alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("__least").alias("cost"),
        *(F.sum(c).alias(f"sum_{i}") for i, c in enumerate(inputs.columns)),
    )


def centroid_sums(df: DataFrame, features: Sequence[str], starts: Sequence[Points]) -> DataFrame:
    """One assignment pass for several centroid sets at once.

    Returns ``start, cluster, n, cost, sum_0..sum_F-1``: per set and cluster the rows assigned, their
    squared distances and feature sums. Rows are combined inside each task before the shuffle,
    which carries at most sets x clusters rows per task whatever the sizes of the clusters.
    """
    width = len(features)
    require_columns(df, features)
    for points in starts:
        _check_points(points, width)
    if sum(map(len, starts)) * width * 8 > CENTROID_BYTES:
        # Fewer sets at a time; each of them passed the check on its own.
        half = len(starts) // 2
        later = centroid_sums(df, features, starts[half:]).withColumn("start", (F.col("start") + half).cast("int"))
        return centroid_sums(df, features, starts[:half]).unionByName(later)
    if len(starts) == 1 and len(starts[0]) * width <= UNROLLED_TERMS:
        return _unrolled_sums(df, features, starts[0])
    sets = [np.asarray(points, dtype="float64") for points in starts]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = [np.zeros((len(points), width + 2)) for points in sets]
        for batch in batches:
            values = _matrix(batch)
            if np.isnan(values).any():
                raise ValueError("cannot assign a row with missing features")
            for points, total in zip(sets, totals):
                cluster, squared = nearest(values, points)
                k = len(points)
                total[:, 0] += np.bincount(cluster, minlength=k)
                total[:, 1] += np.bincount(cluster, squared, minlength=k)
                for f in range(width):
                    total[:, 2 + f] += np.bincount(cluster, values[:, f], minlength=k)
        for start, total in enumerate(totals):
            out = pd.DataFrame(total, columns=["n", "cost", *(f"sum_{i}" for i in range(width))])
            out.insert(0, "cluster", np.arange(len(total), dtype="int32"))
            out.insert(0, "start", np.int32(start))
            yield out.astype({"n": "int64"})[out["n"] > 0]

    sums = [T.StructField(f"sum_{i}", T.DoubleType()) for i in range(width)]
    schema = T.StructType([
        T.StructField("start", T.IntegerType()),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("cost", T.DoubleType()),
        *sums,
    ])
    inputs = df.select(*(as_double(f).alias(f) for f in features))
    return inputs.mapInPandas(partial, schema).groupBy("start", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        *(F.sum(s.name).alias(s.name) for s in sums),
    )


@dataclass
class _Progress:
    points: np.ndarray
    cost: float = float("nan")
    steps: int = 0
    settled: bool = False  # no further move wanted
    scored: bool = False  # `cost` belongs to `points`


def _pass(df: DataFrame, features: Sequence[str], states: list[_Progress], tol: float, move: bool) -> None:
    """Score the centroids of ``states`` in one pass over the table and, if wanted, move them."""
    rows = centroid_sums(df, features, [s.points.tolist() for s in states]).collect()
    for i, state in enumerate(states):
        mine = [r for r in rows if r["start"] == i]
        state.cost, state.scored = float(sum(r["cost"] for r in mine)), True
        if not move:
            continue
        moved = state.points.copy()
        for r in mine:  # a cluster without rows keeps its centroid
            moved[r["cluster"]] = [r[f"sum_{f}"] / r["n"] for f in range(len(features))]
        shift = float(((moved - state.points) ** 2).sum())
        state.settled = shift <= tol
        if shift > 0.0:
            state.points, state.scored = moved, False
            state.steps += 1


def _run(df: DataFrame, features: Sequence[str], starts: Sequence[Points], max_iter: int, tol: float) -> list[_Progress]:
    """Lloyd iterations from every start together: a pass over the table serves all of them."""
    states = [_Progress(np.asarray(points, dtype="float64")) for points in starts]
    for _ in range(max_iter):
        active = [s for s in states if not s.settled]
        if not active:
            break
        _pass(df, features, active, tol, move=True)
    unscored = [s for s in states if not s.scored]
    if unscored:
        _pass(df, features, unscored, tol, move=False)
    return states


def lloyd(
    df: DataFrame, features: Sequence[str], centroids: Points, max_iter: int, tol: float = 0.0
) -> Clustering:
    """Lloyd iterations from given centroids: assign, then move each centroid to its rows' mean.

    Stops after ``max_iter`` moves or once the squared centroid movement is at most ``tol``. Each
    iteration is one aggregate over the table; k rows return to the driver and become literals of
    the next plan, so no lineage builds up.
    """
    state = _run(df, features, [centroids], max_iter, tol)[0]
    return Clustering(tuple(features), tuple(map(tuple, state.points.tolist())), state.cost, state.steps)


def spread(cached: DataFrame) -> DataFrame:
    """Use all cores for an iterative job on a small table; leave larger ones alone.

    ``cached`` must be persisted and computed, so that asking for its partitions runs nothing.
    """
    cores = cached.sparkSession.sparkContext.defaultParallelism
    if cached.rdd.getNumPartitions() >= cores:
        return cached
    dealt = cached.repartition(cores).persist(cached.storageLevel)
    dealt.count()
    cached.unpersist()
    return dealt


def seed_centroids(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int, seed: int, n_init: int) -> list[Points]:
    """``n_init`` seedings of up to ``k`` rows each, drawn from the whole table; see ``blocks.draw_seeds``."""
    return draw_seeds(cut(pack_rows(df, features, keys), "blocks", wide=True), len(features), k, seed, n_init)


def fit_kmeans(
    df: DataFrame,
    features: Sequence[str],
    k: int = 4,
    seed: int = 42,
    max_iter: int = 300,
    n_init: int = 10,
    tol: float = 1e-4,
    keys: Sequence[str] | None = None,
) -> Clustering:
    """K-means on the whole table with ``n_init`` seedings, keeping the lowest inertia.

    Seeds come from the whole table by the hash of ``keys``, which identify rows; without keys a row is
    identified by its features. All restarts iterate over the whole table, one pass for all of them; one that
    has settled takes no further part, and rows that cannot change their cluster are not visited (see
    ``operators.blocks``). The method is the same at every size and on every partitioning.
    ``tol`` is relative to the mean variance of the features. Fewer than ``k`` centroids come back when the rows
    have fewer distinct values.
    """
    if k < 1 or n_init < 1:
        raise ValueError("k and n_init must be at least 1")
    require_columns(df, [*features, *(keys or ())])
    extra = [c for c in keys or () if c not in features]
    mine = not (df.storageLevel.useMemory or df.storageLevel.useDisk)  # else the caller keeps it cached
    table = df.select(*extra, *(as_double(f).alias(f) for f in features))
    if mine:
        table = table.persist(StorageLevel.DISK_ONLY)  # read twice
    try:
        moments = column_moments(table, features).collect()
        rows = moments[0]["n_rows"]
        holes = {r["feature"]: rows - r["n"] for r in moments if r["n"] < rows}
        if holes:
            raise ValueError(f"Missing values per column: {holes}")
        if rows < k:
            raise ValueError(f"{rows} rows cannot form {k} clusters")
        endless = [r["feature"] for r in moments if not math.isfinite(r["std"])]
        if endless:
            raise ValueError(f"Columns without finite mean and deviation: {endless}")
        if mine:
            table = spread(table)
        limit = tol * float(np.mean([r["std"] ** 2 for r in moments]))
        blocks = cut(pack_rows(table, features, keys or features), "blocks", wide=True)
    finally:
        if mine:
            table.unpersist()
    starts = draw_seeds(blocks, len(features), k, seed, n_init)
    # Every pass reads the files: a copy in the executors' memory would take it from the rows that are being read.
    best = min(BoundedLloyd(blocks.select("n", "body"), rows, max_iter, limit).run(starts), key=lambda s: s.cost)
    if len(best.points) < k:
        log.warning("found %d distinct centroids instead of %d", len(best.points), k)
    return Clustering(tuple(features), tuple(map(tuple, best.points.tolist())), best.cost, best.steps)


def sorted_centroids(model: Clustering) -> Clustering:
    """The same model with clusters numbered by their centroids, so that fits can be compared."""
    return Clustering(model.features, tuple(sorted(model.centroids)), model.inertia, model.iterations)
