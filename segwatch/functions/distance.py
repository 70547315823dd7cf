"""Squared Euclidean distances between rows and fixed centroids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TIED_CELLS = 1 << 20  # differences held at once when rows are ranked again


def squared_distance(values: Sequence[Column], point: Sequence[float]) -> Column:
    """Sum of squared differences, as one JVM expression in feature order."""
    terms = [(v - F.lit(float(p))) * (v - F.lit(float(p))) for v, p in zip(values, point)]
    return reduce(lambda a, b: a + b, terms)


def column_distance(left: Sequence[Column], right: Sequence[Column]) -> Column:
    terms = [(a - b) * (a - b) for a, b in zip(left, right)]
    return F.sqrt(reduce(lambda a, b: a + b, terms))


def nearest(rows: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest of ``points``; the lowest index wins a tie.

    A matrix product ranks the points. Rows whose two best are closer together than the product's
    rounding error are ranked again by the plain differences.
    """
    ranking = (points * points).sum(axis=1) - 2.0 * (rows @ points.T)
    best = ranking.argmin(axis=1)
    if len(points) > 1:
        two = np.partition(ranking, 1, axis=1)[:, :2]
        size = (rows * rows).sum(axis=1) + (points * points).sum(axis=1).max()
        close = np.flatnonzero(two[:, 1] - two[:, 0] <= 1e-12 * rows.shape[1] * size)
        step = max(1, TIED_CELLS // points.size)
        for at in range(0, len(close), step):
            some = close[at:at + step]
            best[some] = ((rows[some, None, :] - points[None]) ** 2).sum(axis=2).argmin(axis=1)
    return best, ((rows - points[best]) ** 2).sum(axis=1)


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All Euclidean distances of two small blocks, from plain differences."""
    total = np.zeros((len(left), len(right)))
    for f in range(left.shape[1]):
        step = left[:, f, None] - right[None, :, f]
        total += step * step
    return np.sqrt(total)
