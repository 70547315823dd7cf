"""P-values of the two-sided two-sample Kolmogorov-Smirnov statistic.

Both samples up to ``EXACT_ROWS``: the exact distribution, for equal sizes its closed form in the JVM. Otherwise the
one-sample distribution of the statistic at the effective size round(n m / (n + m)): exact up to
``EXACT_SIZE``, and from published expansions beyond, where these are within 2e-9 of it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_ROWS = 10_000
EXACT_SIZE = 32_768  # effective sizes up to here walk the process between its bounds; the expansions' error falls as 1 / size^2
ONE_SIDED_FROM = 4.0  # size * statistic^2 above which crossing both bounds has a probability below 1e-13
NEGLIGIBLE = 1e-22  # Poisson probabilities left out
TAIL_FROM = 2.0  # scaled statistic above which only the one-sided tail counts
SERIES_TERMS = 8


def exact_two_sample(n: int, m: int, statistic: float) -> float:
    """P(D >= statistic) when every merge of samples of sizes n and m is equally likely.

    Walks the merge one value at a time and sums the probability of first reaching the statistic,
    so small values keep their precision.
    """
    n, m = min(n, m), max(n, m)
    common = math.gcd(n, m)
    up, right = m // common, n // common
    reach = round(statistic * n * up)  # statistic as a multiple of 1 / lcm(n, m)
    if reach <= 0:
        return 1.0
    total = n + m
    # inside[i]: probability of i values of the first sample among those seen, statistic not reached
    inside = np.zeros(n + 1)
    inside[0] = 1.0
    low = high = 0
    outside = 0.0
    counts = np.arange(n + 1)
    for seen in range(1, total + 1):
        high = min(high + 1, n)
        i = counts[low:high + 1]
        left = total - seen + 1
        stay = inside[low:high + 1] * np.maximum(m - (seen - 1 - i), 0) / left
        stay[1:] += inside[low:high] * (n - i[1:] + 1) / left
        over = np.abs(i * up - (seen - i) * right) >= reach
        outside += stay[over].sum()
        stay[over] = 0.0
        inside[low:high + 1] = stay
        while low < high and inside[low] == 0.0:
            low += 1
        while high > low and inside[high] == 0.0:
            high -= 1
    return float(min(outside, 1.0))


def _poisson(mean: float) -> np.ndarray:
    """Probabilities of 0, 1, ... events, down to where nothing is left."""
    out = [math.exp(-mean)]
    while len(out) <= mean or out[-1] > NEGLIGIBLE:
        out.append(out[-1] * mean / len(out))
    return np.array(out)


def _log_poisson(k: np.ndarray, mean: float) -> np.ndarray:
    return k * math.log(mean) - mean - np.array([math.lgamma(x + 1.0) for x in k]) if mean > 0 else np.where(k == 0, 0.0, -np.inf)


def one_sided(n: int, statistic: float) -> float:
    """P(sup(F_n - F) >= statistic), a sum of positive terms."""
    j = np.arange(int(n * (1.0 - statistic)) + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    up, left = statistic + j / n, 1.0 - statistic - j / n
    with np.errstate(divide="ignore"):
        rest = np.where(j == n, 0.0, (n - j) * np.log(np.maximum(left, 0.0)))
    terms = logs[n] - logs[j] - logs[n - j] + (j - 1) * np.log(up) + rest
    return float(min(1.0, statistic * np.exp(terms).sum()))


def exact_one_sample(n: int, statistic: float) -> float:
    """P(D_n >= statistic) for one sample of size n.

    Given their number, the points of a Poisson process are such a sample. Counted up to time t (of n), they have to stay
    above t - n d and below t + n d; it is enough to look when a count becomes too small or is no longer too
    large. From one such time to the next the counts' probabilities are convolved with a short Poisson
    distribution, and what is out of bounds is dropped. Far out both sides are one-sided sums.
    """
    if statistic >= 1.0:
        return 0.0
    reach = n * statistic
    if reach <= 0.5:
        return 1.0
    if reach * statistic >= ONE_SIDED_FROM:
        return min(1.0, 2.0 * one_sided(n, statistic))
    large = [(j - reach, True, j) for j in range(1, n + 1) if 0.0 < j - reach < n]  # up to then there are fewer than j
    small = [(j + reach, False, j) for j in range(n) if j + reach < n]  # from then on there are more than j
    counts, low, now, log_scale = np.ones(1), 0, 0.0, 0.0
    kernels: dict[float, np.ndarray] = {}
    for time, upper, j in sorted(large + small):
        gap = time - now
        key = round(gap, 9)  # nearly all gaps are one of two
        if key not in kernels:
            kernels[key] = _poisson(gap)
        counts, now = np.convolve(counts, kernels[key]), time
        if upper:
            counts = counts[:j - low]
        elif j >= low:
            counts, low = counts[j + 1 - low:], j + 1
        top = counts.max(initial=0.0)
        if top == 0.0:
            return 1.0
        if top < 1e-100:
            counts = counts / top
            log_scale += math.log(top)
    at = np.arange(low, low + len(counts))
    fits = at <= n
    last = np.exp(_log_poisson((n - at[fits]).astype(float), n - now))
    whole = _log_poisson(np.array([float(n)]), float(n))[0]
    inside = float((counts[fits] * last).sum())
    return float(min(max(1.0 - math.exp(math.log(inside) + log_scale - whole), 0.0), 1.0)) if inside > 0 else 1.0


def equal_size_p(n: Column, reach: Column) -> Column:
    """P(D >= reach / n) for two samples of size ``n`` (bigint), a closed alternating sum, as one loop in the JVM.

    The k-th term, C(2n, n - k reach) / C(2n, n), is the product of the first k reach factors (n - i + 1) / (n + i).
    """
    state = F.struct(F.lit(1.0).alias("product"), F.lit(0.0).alias("total"))

    def step(s: Column, i: Column) -> Column:
        product = s["product"] * (n - i + 1) / (n + i)
        k = i / reach
        sign = F.when(F.pmod(F.floor(k), F.lit(2)) == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.struct(product.alias("product"), (s["total"] + F.when(i % reach == 0, sign * product).otherwise(F.lit(0.0))).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n), state, step, lambda s: 2.0 * s["total"])
    return F.when(reach <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


@F.pandas_udf(T.DoubleType())
def small_size_p(n: pd.Series, m: pd.Series, statistic: pd.Series) -> pd.Series:
    """P-values for the sizes without a closed expression; NULL for all others."""

    def one(n: int, m: int, d: float) -> float | None:
        if max(n, m) <= EXACT_ROWS:
            return None if n == m else exact_two_sample(n, m, d)
        effective = round(n * m / (n + m))
        return exact_one_sample(effective, d) if effective <= EXACT_SIZE else None

    return pd.Series([one(int(a), int(b), float(d)) for a, b, d in zip(n, m, statistic)], dtype="float64")


def _sum_over(values: list[float], term: Callable[[Column], Column]) -> Column:
    """Sum of ``term`` over constants, kept as one small loop in the generated code."""
    constants = F.array(*(F.lit(v) for v in values))
    return F.aggregate(constants, F.lit(0.0), lambda total, v: total + term(v))


def _series(z: Column, root: Column) -> Column:
    """Distribution of the scaled statistic with corrections up to n^(-3/2) (Pelz and Good 1976)."""
    z2 = z * z
    z4 = z2 * z2
    z6 = z4 * z2
    odd = [(math.pi * (i + 0.5)) ** 2 for i in range(SERIES_TERMS)]
    even = [(math.pi * i) ** 2 for i in range(1, SERIES_TERMS)]

    def weighted(polynomial: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda q: polynomial(q) * F.exp(F.lit(-0.5) * q / z2)

    k0 = _sum_over(odd, weighted(lambda q: F.lit(1.0)))
    k1 = _sum_over(odd, weighted(lambda q: q - z2))
    k2 = _sum_over(odd, weighted(
        lambda q: 6.0 * z6 + 2.0 * z4 + q * (2.0 * z4 - 5.0 * z2) + q * q * (1.0 - 2.0 * z2)
    ))
    k3 = _sum_over(odd, weighted(
        lambda q: q * q * q * (5.0 - 30.0 * z2) + q * q * (212.0 * z4 - 60.0 * z2)
        + q * (135.0 * z4 - 96.0 * z6) - 30.0 * z6 - 90.0 * z4 * z4
    ))
    even2 = _sum_over(even, weighted(lambda q: q))
    even3 = _sum_over(even, weighted(lambda q: 3.0 * q * z2 - q * q))
    half = math.sqrt(math.pi / 2.0)
    # Each sum runs over positive and negative indices alike, hence the doubled factors.
    t0 = 2.0 * half / z * k0
    t1 = half / 3.0 / z4 * k1
    t2 = half / 36.0 / (z6 * z) * k2 - half / 18.0 / (z2 * z) * even2
    t3 = half / 3240.0 / (z6 * z4) * k3 + half / 54.0 / z6 * even3
    return t0 + t1 / root + t2 / (root * root) + t3 / (root * root * root)


def asymptotic_p(statistic: Column, size: Column, root: Column, z: Column) -> Column:
    """P-value from the effective sample size, its root and the scaled statistic, in the JVM."""
    z2 = z * z
    tail = 2.0 * F.exp(-2.0 * z2 - 2.0 / 3.0 * z / root + 4.0 / 9.0 * (z2 - z2 * z2) / size)
    # Below 0.2 the distribution function is under 1e-12.
    body = F.when(z < 0.2, F.lit(1.0)).otherwise(1.0 - _series(z, root))
    p = F.when(statistic >= 1.0, F.lit(0.0)).when(z >= TAIL_FROM, tail).otherwise(body)
    return F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0))


def with_ks_p_value(df: DataFrame, n: str, m: str, statistic: str, output: str = "p_value") -> DataFrame:
    """Add the two-sided p-value by the automatic rule described above."""
    a, b = F.col(n).cast("double"), F.col(m).cast("double")
    scaled = (
        df.withColumn("__size", F.rint(a * b / (a + b)))
        .withColumn("__root", F.sqrt("__size"))
        .withColumn("__z", F.col(statistic) * F.col("__root"))
    )
    p = asymptotic_p(F.col(statistic), F.col("__size"), F.col("__root"), F.col("__z"))
    whole = F.col(n).cast("bigint")
    closed = F.when((a == b) & (a <= EXACT_ROWS) & (a > 0), equal_size_p(whole, F.rint(F.col(statistic) * a).cast("bigint")))
    return scaled.withColumn(output, F.coalesce(closed, small_size_p(n, m, statistic), p)).drop("__size", "__root", "__z")
