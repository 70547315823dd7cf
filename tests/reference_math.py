"""Plain NumPy restatements of the measures, for small inputs."""

import itertools
import math

import numpy as np


def pairwise(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def silhouette(x, labels):
    labels = np.asarray(labels)
    d = pairwise(np.asarray(x, dtype=float))
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {own})
        scores.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(scores))


def davies_bouldin(x, labels):
    x, labels = np.asarray(x, dtype=float), np.asarray(labels)
    names = sorted(set(labels))
    centres = np.array([x[labels == n].mean(axis=0) for n in names])
    spread = np.array([np.sqrt(((x[labels == n] - c) ** 2).sum(axis=1)).mean() for n, c in zip(names, centres)])
    apart = pairwise(centres)
    if np.allclose(spread, 0) or np.allclose(apart, 0):
        return 0.0
    worst = []
    for i in range(len(names)):
        ratios = [(spread[i] + spread[j]) / apart[i, j] for j in range(len(names)) if apart[i, j] > 0]
        worst.append(max(ratios, default=0.0))
    return float(np.mean(worst))


def ks(a, b):
    a, b = np.sort(np.asarray(a, dtype=float)), np.sort(np.asarray(b, dtype=float))
    at = np.concatenate([a, b])
    gap = np.searchsorted(a, at, side="right") / len(a) - np.searchsorted(b, at, side="right") / len(b)
    return float(np.abs(gap).max())


def exact_p(n, m, statistic):
    """Share of all interleavings of n and m values whose statistic is at least the given one."""
    hits = total = 0
    for first in itertools.combinations(range(n + m), n):
        step = np.full(n + m, -1 / m)
        step[list(first)] = 1 / n
        hits += np.abs(np.cumsum(step)).max() >= statistic - 1e-12
        total += 1
    return hits / total


def exact_p_equal(n, h):
    """2 sum (-1)^(k-1) C(2n, n - kh) / C(2n, n) for equal sizes."""
    if h == 0:
        return 1.0
    middle = math.comb(2 * n, n)
    return 2 * sum((-1) ** (k - 1) * math.comb(2 * n, n - k * h) / middle for k in range(1, n // h + 1))


def nearest(x, centroids):
    d = ((np.asarray(x, dtype=float)[:, None, :] - np.asarray(centroids, dtype=float)[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def lloyd(x, centroids, steps):
    c = np.array(centroids, dtype=float)
    for _ in range(steps):
        labels, _ = nearest(x, c)
        c = np.array([x[labels == j].mean(axis=0) if (labels == j).any() else c[j] for j in range(len(c))])
    return c


def matrix_p(n, d):
    """P(D_n >= d) of one sample by the power of a banded matrix."""
    k = math.ceil(n * d)
    gap, size = k - n * d, 2 * k - 1
    step = np.tril(np.ones((size, size)), 1)
    edge = gap ** np.arange(1, size + 1)
    step[:, 0] -= edge
    step[-1, :] -= edge[::-1]
    step[-1, 0] += max(2 * gap - 1, 0) ** size
    row, column = np.indices((size, size))
    step *= np.exp(-np.array([math.lgamma(j + 1) for j in range(size + 1)])[np.clip(row - column + 1, 0, size)])
    out, scale, base, base_scale = np.eye(size), 0.0, step, 0.0
    left = n
    while left:
        if left & 1:
            out = out @ base
            scale += base_scale + math.log(out.max())
            out /= out.max()
        base = base @ base
        base_scale = 2 * base_scale + math.log(base.max())
        base /= base.max()
        left >>= 1
    return 1 - out[k - 1, k - 1] * math.exp(scale + math.lgamma(n + 1) - n * math.log(n))
