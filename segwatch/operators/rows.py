"""Choosing rows: deterministic head, bounded sample and a split at a rank of an explicit order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segwatch.functions.columns import is_missing, key_digest, require_columns
from segwatch.operators.sketches import Sketch, sketched

DIGEST_DIGITS = 32
FEW_ROWS = 8
SMALL_RANGE = 10_000  # rows that a top-k may bring to one task
PIVOTS_PER_PASS = 16
PIVOT_SAMPLE = 100_000
PIVOT_STEPS = (-0.05, -0.005, -0.001, 0.0, 0.001, 0.005, 0.05)
MARKS = 1000  # quantiles of the first order column that come with the counts
SKETCH_SIZE = 4096


def head(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order (a per-partition top-k, never a full sort)."""
    return df.orderBy(*keys).limit(n)


def bounded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement: those with the smallest hash of key and seed.

    ``keys`` should identify rows; rows sharing a key enter together, up to ``n``. The choice depends
    on the keys alone, so it is the same on every run and partitioning. A plain top-k would send
    ``n`` rows per partition to the last task, which on a table of many partitions is far more than
    ``n``. So one narrow pass over the keys counts rows by the magnitude of their
    hash (at most 480 groups); the smallest magnitude with at least ``n`` hashes up to it then bounds
    the rows that take part in the top-k to about ``2 n``.
    """
    require_columns(df, keys)
    digest = key_digest(keys, seed)
    if n <= FEW_ROWS:
        return df.withColumn("__digest", digest).orderBy("__digest", *keys).limit(n).drop("__digest")
    # Hexadecimal text of one length sorts like the number. Its magnitude is the number of digits
    # after the leading zeros and the first of them.
    digits = F.ltrim(digest, F.lit("0"))
    counts = df.groupBy(F.length(digits).alias("digits"), F.left(digits, F.lit(1)).alias("first")).agg(
        F.count(F.lit(1)).alias("n")
    )
    below, last = 0, "g"  # sorts after every digit
    for row in sorted(counts.collect(), key=lambda r: (r["digits"], r["first"])):
        below += row["n"]
        if below >= n:
            last = "0" * (DIGEST_DIGITS - row["digits"]) + row["first"] + "g"
            break
    return (
        df.where(digest < F.lit(last))
        .withColumn("__digest", digest)
        .orderBy("__digest", *keys)
        .limit(n)
        .drop("__digest")
    )


def _numeric_order(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _constant(df: DataFrame, column: str, value: object) -> Column:
    """A literal of the column's own type (a plain timestamp literal would follow the time zone)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(str(value)).cast(kind)
    return F.lit(value)


def _pivots(df: DataFrame, column: str, share: float, size: int) -> list:
    """Values of ``column`` around the wanted share of the rows; any values would be correct.

    They come from a sample, since a quantile sketch of every partition of a large table would be
    too much for the one task that merges them. Text has no sketch and takes values by hash.
    """
    if _numeric_order(df, column):
        shares = sorted({min(max(share + step, 0.0), 1.0) for step in PIVOT_STEPS})
        pivots = F.percentile_approx(column, shares)
        fraction = PIVOT_SAMPLE / size
        found = df.sample(fraction, seed=0).agg(pivots).head()[0] if fraction < 1 else None
        return sorted(set(found or df.agg(pivots).head()[0]))
    found = df.agg(*(F.min_by(column, F.xxhash64(column, F.lit(i))) for i in range(PIVOTS_PER_PASS))).head()
    return sorted(set(found))


def _near(quantiles: Sequence, share: float) -> list:
    """Those of evenly spread ``quantiles`` that lie around ``share`` of the rows."""
    last = len(quantiles) - 1
    places = (round((share + step) * last) for step in PIVOT_STEPS)
    return sorted({quantiles[min(max(place, 0), last)] for place in places})


def _narrowed(inside: DataFrame, column: str, pivots: Sequence, wanted: int, size: int) -> tuple[DataFrame, int, int, object]:
    """The rows that can hold place ``wanted`` of ``column``, how many come before them, how many they are, and
    the value they share, if a pivot is the one. One map-side combined aggregate counts around all pivots."""
    measures = []
    for i, pivot in enumerate(pivots):
        at = _constant(inside, column, pivot)
        measures.append(F.count_if(F.col(column) < at).alias(f"lt_{i}"))
        measures.append(F.count_if(F.col(column) <= at).alias(f"le_{i}"))
    counts = inside.agg(*measures).head()
    low = high = None
    low_count, high_count = 0, size
    for i, pivot in enumerate(pivots):
        lt, le = counts[f"lt_{i}"], counts[f"le_{i}"]
        if lt <= wanted < le:
            return inside.where(F.col(column) == _constant(inside, column, pivot)), lt, le - lt, pivot
        if le <= wanted:
            low, low_count = pivot, le
        elif high is None:
            high, high_count = pivot, lt
    if low is not None:
        inside = inside.where(F.col(column) > _constant(inside, column, low))
    if high is not None:
        inside = inside.where(F.col(column) < _constant(inside, column, high))
    return inside, low_count, high_count - low_count, None


def value_at_rank(df: DataFrame, column: str, rank: int) -> tuple[object, int, int]:
    """The value at 0-based ``rank`` of ``column`` in ascending order, how many are below, how many equal.

    Each round counts, in one map-side combined aggregate, the rows below and up to a handful of
    pivots, and keeps only the open interval that still holds the rank. Nothing is sorted or
    shuffled, a value of any frequency is one pivot, and the answer is exact.
    """
    inside, below = df.select(column), 0
    size = inside.count()
    if not 0 <= rank < size:
        raise IndexError(f"rank {rank} outside a table of {size} rows")
    while True:
        wanted = rank - below
        if size <= SMALL_RANGE:
            pivots = [inside.orderBy(column).limit(wanted + 1).agg(F.max(column)).head()[0]]
        else:
            pivots = _pivots(inside, column, wanted / size, size)
        inside, before, size, value = _narrowed(inside, column, pivots, wanted, size)
        below += before
        if value is not None:
            return value, below, size


def _boundary(df: DataFrame, order: Sequence[str], rank: int, size: int, quantiles: Sequence) -> list[object]:
    """The key at ``rank`` of ``size`` rows, narrowed down by one order column after the other.

    ``quantiles`` of the first column, if known, save the first look for pivots. As soon as few rows are left, they
    are ordered by the whole key, and only the one at the rank and the one before it are fetched.
    """
    inside, wanted, boundary = df.select(*order), rank, []
    for column in order:
        value = None
        while value is None:
            if size <= SMALL_RANGE:
                last = inside.orderBy(*order).offset(max(wanted - 1, 0)).limit(min(wanted, 1) + 1).collect()
                if wanted and last[0] == last[1]:
                    raise ValueError(f"order columns {list(order)} do not tell the rows at rank {rank} apart")
                return list(last[-1])
            pivots = _near(quantiles, wanted / size) if quantiles else _pivots(inside, column, wanted / size, size)
            quantiles = ()
            inside, before, size, value = _narrowed(inside, column, pivots, wanted, size)
            wanted -= before
        boundary.append(value)
    if wanted:
        raise ValueError(f"order columns {list(order)} do not tell the rows at rank {rank} apart")
    return boundary


def _before(df: DataFrame, order: Sequence[str], boundary: Sequence[object]) -> Column:
    """Lexicographic ``order < boundary`` as plain comparisons, which reach the file scan."""
    at = [_constant(df, column, value) for column, value in zip(order, boundary)]
    tests = []
    for i, column in enumerate(order):
        equal = [F.col(order[j]) == at[j] for j in range(i)]
        tests.append(reduce(lambda a, b: a & b, [*equal, F.col(column) < at[i]]))
    return reduce(lambda a, b: a | b, tests)


def _before_place(df: DataFrame, order: Sequence[str], place: Callable[[int], int]) -> Column:
    """A condition true for the first ``place(number of rows)`` rows. One pass counts the rows and missing values and
    sketches the first order column."""
    require_columns(df, order)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    missing = [F.count_if(is_missing(c) if c in floating else F.col(c).isNull()) for c in order]
    held = [order[0]] if Sketch.can_hold(df.schema[order[0]].dataType) else []
    marks = [i / MARKS for i in range(MARKS + 1)]
    sketches, (n, *without) = sketched(df.select(*order), held, marks, SKETCH_SIZE, [F.count(F.lit(1)), *missing])
    if any(without):
        raise ValueError(f"order columns with missing values: {[c for c, count in zip(order, without) if count]}")
    rank = place(n)
    if rank >= n:
        return F.lit(True)
    return _before(df, order, _boundary(df, order, rank, n, sketches[0][1] if held else ()))


def before_rank(df: DataFrame, order: Sequence[str], rank: int) -> Column:
    """A condition true for exactly the first ``rank`` rows of ``df`` in ``order``.

    Only the key at the boundary is searched for; the split is then a narrow filter and the table
    itself is never ranked. The order must tell the rows at the boundary apart, and its columns may
    hold neither NULL nor NaN.
    """
    if rank < 0:
        raise ValueError("rank must not be negative")
    return _before_place(df, order, lambda n: rank)


def before_middle(df: DataFrame, order: Sequence[str]) -> Column:
    """``before_rank`` at half the number of rows, rounded down, which the same pass counts."""
    return _before_place(df, order, lambda n: n // 2)


def split_at_rank(df: DataFrame, order: Sequence[str], rank: int) -> tuple[DataFrame, DataFrame]:
    """The first ``rank`` rows in ``order``, and the rest."""
    first = before_rank(df, order, rank)
    return df.where(first), df.where(~first)


def split_halves(
    reference: DataFrame, current: DataFrame, order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The first half of ``reference`` and ``current`` from that same position on.

    The position comes from ``reference`` alone, so a shorter ``current`` may come out empty.
    """
    if current is reference:
        first = before_middle(reference, order)
        return reference.where(first), reference.where(~first)
    middle = reference.count() // 2
    return reference.where(before_rank(reference, order, middle)), current.where(~before_rank(current, order, middle))
