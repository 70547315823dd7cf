"""Two-sample Kolmogorov-Smirnov drift of many features in one plan."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segwatch.functions.columns import is_missing, nan_to_null, require_columns
from segwatch.functions.pvalue import with_ks_p_value
from segwatch.functions.storage import cut
from segwatch.operators.sketches import sketched

MIN_BUCKETS = 256
BUCKETS_PER_ROOT = 1
MAX_BUCKET_ROWS = 1 << 18  # features x buckets of the first round: what is broadcast, about 16 MB
PIECES = 64  # parts of an open bucket in each further round
SORTED_ROWS = 1 << 16  # an open bucket with more rows is parted again
SKETCH_MARKS = 2048  # quantiles of a feature that place the bounds; they affect balance, never the result
SKETCH_SIZE = 8192


def both_sides(reference: DataFrame, current: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """Stack two tables; ``side`` is true for rows of ``reference``."""
    require_columns(reference, features)
    require_columns(current, features)
    return reference.select(*features, F.lit(True).alias(side)).unionAll(
        current.select(*features, F.lit(False).alias(side))
    )


def drop_missing(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``feature, value`` without missing values; each feature drops only its own."""
    pairs = F.array(*(
        F.struct(F.lit(f).alias("feature"), nan_to_null(f).alias("value")) for f in features
    ))
    return df.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())


def _bounds(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Roughly equally filled, strictly increasing bucket bounds of each feature, with open ends.

    Without drift the largest gap is about 1 / sqrt(rows); buckets of no more weight than that let
    most of them be ruled out after counting. One pass of merged sketches gives the sizes and quantiles of all
    features; where more buckets are wanted than it has quantiles, bounds lie evenly between them.
    """
    values = df.select(*(F.col(f).cast("double").alias(f"v{i}") for i, f in enumerate(features)))
    most = max(2, MAX_BUCKET_ROWS // len(features))
    marks = [i / min(SKETCH_MARKS, most) for i in range(min(SKETCH_MARKS, most) + 1)]
    found, _ = sketched(values, values.columns, marks, SKETCH_SIZE)
    bounds = []
    for rows, quantiles in found:
        buckets = min(max(MIN_BUCKETS, math.isqrt(rows) * BUCKETS_PER_ROOT), most)
        shares = [i / buckets for i in range(1, buckets)]
        inner = np.interp(shares, marks, quantiles).tolist() if quantiles else []  # between infinite ones not finite
        bounds.append([-math.inf, *(sorted({b + 0.0 for b in inner if math.isfinite(b)}) or [0.0]), math.inf])
    return bounds


def _bucketed(df: DataFrame, features: Sequence[str], side: str, bounds: list[list[float]]) -> DataFrame:
    """Long form ``f, bucket, value, is_reference``; the bucket depends on the value alone."""
    values = [f"__v{i}" for i in range(len(features))]
    buckets = [f"__b{i}" for i in range(len(features))]
    wide = df.select(F.col(side).alias("is_reference"), *(
        # Bucketizer wants a number in every row; missing values are filtered below. Adding zero turns
        # -0.0 into 0.0, which are equal but which its binary search would keep apart.
        F.when(is_missing(f), F.lit(math.nan)).otherwise(F.col(f).cast("double") + F.lit(0.0)).alias(v)
        for f, v in zip(features, values)
    ))
    bucketizer = Bucketizer(splitsArray=bounds, inputCols=values, outputCols=buckets, handleInvalid="keep")
    rows = F.array(*(
        F.struct(F.lit(i).alias("f"), F.col(b).cast("int").alias("bucket"), F.col(v).alias("value"))
        for i, (b, v) in enumerate(zip(buckets, values))
    ))
    return bucketizer.transform(wide).select("is_reference", F.inline(rows)).where(~F.isnan("value"))


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def _parted(rows: DataFrame, open_buckets: DataFrame) -> DataFrame:
    """The rows of the open buckets, dealt anew by quantiles of their bucket, with the old bucket as ``parent``.

    A quantile's own value is a bucket by itself, so a frequent value never keeps others from being parted.
    """
    shares = [i / PIECES for i in range(1, PIECES)]
    marks = cut(
        rows.join(open_buckets.select("f", "bucket"), ["f", "bucket"], "left_semi")
        .groupBy("f", "bucket").agg(F.percentile_approx("value", shares, 4 * PIECES).alias("marks")),
        "marks",
    )
    below = F.size(F.filter("marks", lambda m: m < F.col("value")))
    upto = F.size(F.filter("marks", lambda m: m <= F.col("value")))
    return rows.join(marks, ["f", "bucket"]).select(
        "is_reference", "f", F.col("bucket").alias("parent"),
        (F.col("bucket").cast("bigint") * (2 * PIECES) + below + upto).alias("bucket"), "value",
    )


def ks_by_side(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """``feature, ks_stat, n_ref, n_curr`` between the rows where ``side`` is true and the others.

    The exact largest gap between the two empirical distribution functions, in stages:

    1. Count both sides per bucket of values. The combined counts are features x buckets rows, and
       give the gap at every bucket edge and an upper limit of it inside every bucket.
    2. Only buckets of several values whose limit exceeds the largest gap already found can hold a
       larger one. While one of them has more than ``SORTED_ROWS`` rows, these open buckets are parted and
       counted again, and the gaps at the new edges rule out more of them.
    3. The rows of the last open buckets are counted per distinct value (combined on the map side, so a value
       of any frequency travels as one row per task) and summed up in order within the bucket.

    Missing values are dropped per feature. Raises ``ValueError`` when a side has none left.
    """
    require_columns(df, [*features, side])
    features = list(features)
    rows = _bucketed(df, features, side, _bounds(df, features))
    counted = [
        F.count_if(F.col("is_reference")).alias("n_ref"),
        F.count_if(~F.col("is_reference")).alias("n_curr"),
    ]
    one_value = (F.min("value") == F.max("value")).alias("one_value")

    def gap(ref: str, curr: str) -> Column:
        return F.abs(F.try_divide(F.col(ref), F.col("all_ref")) - F.try_divide(F.col(curr), F.col("all_curr")))

    def with_gaps(counts: DataFrame, *within: str) -> DataFrame:
        """Add to counts with ``base_ref`` and ``base_curr`` rows before them what lies before and up to each bucket."""
        up_to_here = Window.partitionBy("f", *within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        return (
            counts.withColumns({s: F.col(f"base_{s[5:]}") + F.sum(f"n_{s[5:]}").over(up_to_here) for s in ("upto_ref", "upto_curr")})
            .withColumns({"from_ref": F.col("upto_ref") - F.col("n_ref"), "from_curr": F.col("upto_curr") - F.col("n_curr")})
            .withColumn("at_edge", gap("upto_ref", "upto_curr"))
            # Inside a bucket the gap is widest if one side's values all come first.
            .withColumn("inside", F.greatest(gap("upto_ref", "from_curr"), gap("from_ref", "upto_curr")))
        )

    feature = Window.partitionBy("f")
    n_rows = F.col("n_ref") + F.col("n_curr")

    def with_verdicts(counts: DataFrame, known: Column) -> DataFrame:
        """Add the largest gap at an edge, or ``known``, and of one row of each feature the largest open bucket."""
        may_hold = ~F.col("one_value") & (F.col("inside") > F.col("largest"))
        return (
            counts.withColumn("largest", F.greatest(F.max("at_edge").over(feature), known))
            .withColumn("is_open", may_hold)
            .withColumn("open_rows", F.coalesce(F.max(F.when(F.col("is_open"), n_rows)).over(feature), F.lit(0)))
            .withColumn("speaks", F.row_number().over(feature.orderBy("bucket")) == 1)
        )

    first = rows.groupBy("f", "bucket").agg(*counted, one_value).withColumns({
        "all_ref": F.sum("n_ref").over(feature), "all_curr": F.sum("n_curr").over(feature),
        "base_ref": F.lit(0), "base_curr": F.lit(0),
    })
    edges = cut(with_verdicts(with_gaps(first), F.lit(0.0)), "edges")
    small = F.broadcast  # the first round's buckets have a fixed limit; Spark measures those of later rounds
    found: dict[int, tuple[int, int, float]] = {}
    while True:
        spoken = edges.where("speaks").select("f", "all_ref", "all_curr", "largest", "open_rows").collect()
        found.update({r["f"]: (r["all_ref"], r["all_curr"], r["largest"]) for r in spoken})
        for i, name in enumerate(features):
            sizes = found.get(i, (0, 0))[:2]
            if 0 in sizes:
                raise ValueError(f"Feature {name} has no values on one side: {sizes[0]} and {sizes[1]} rows")
        open_buckets = small(edges.where("is_open").select(
            "f", "bucket", "from_ref", "from_curr", "all_ref", "all_curr", "largest"
        ))
        if max((r["open_rows"] for r in spoken), default=0) <= SORTED_ROWS:
            break
        rows = cut(_parted(rows, open_buckets), "open-rows")  # only these are left, and later rounds start from them
        parents = open_buckets.select(
            "f", F.col("bucket").alias("parent"), F.col("from_ref").alias("base_ref"),
            F.col("from_curr").alias("base_curr"), "all_ref", "all_curr", F.col("largest").alias("known"),
        )
        parts = rows.groupBy("f", "parent", "bucket").agg(*counted, one_value).join(parents, ["f", "parent"])
        edges = cut(with_verdicts(with_gaps(parts, "parent"), F.col("known")), "edges")
        small = _as_it_is

    before = ["from_ref", "from_curr", "all_ref", "all_curr"]
    distinct = (
        rows.join(open_buckets, ["f", "bucket"])
        .groupBy("f", "bucket", "value").agg(*counted, *(F.first(c).alias(c) for c in before))
    )
    ordered = Window.partitionBy("f", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    inner = distinct.withColumns({
        f"here_{s}": F.col(f"from_{s}") + F.sum(f"n_{s}").over(ordered) for s in ("ref", "curr")
    }).select("f", gap("here_ref", "here_curr").alias("ks_stat"))
    at_edges = df.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(i).alias("f"), F.lit(largest).alias("ks_stat")) for i, (_, _, largest) in sorted(found.items())
    ))))
    known = F.array(*(F.struct(F.lit(name).alias("feature"), *(
        F.lit(n).cast("bigint").alias(c) for n, c in zip(found[i], ("n_ref", "n_curr"))
    )) for i, name in enumerate(features)))
    return at_edges.unionAll(inner).groupBy("f").agg(F.max("ks_stat").alias("ks_stat")).select(
        known[F.col("f")].alias("known"), "ks_stat"
    ).select("known.feature", "ks_stat", "known.n_ref", "known.n_curr")


def ks_statistic(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, ks_stat, n_ref, n_curr`` of two tables."""
    return ks_by_side(both_sides(reference, current, features, "__side"), features, "__side")


def with_p_value(statistics: DataFrame) -> DataFrame:
    """Add ``p_value`` to ``feature, ks_stat, n_ref, n_curr``."""
    return with_ks_p_value(statistics, "n_ref", "n_curr", "ks_stat")


def with_verdict(tests: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Add ``drifted``: the p-value is below, and not equal to, the threshold."""
    return tests.withColumn("drifted", F.col("p_value") < F.lit(threshold))


def drift_report(
    reference: DataFrame, current: DataFrame, features: Sequence[str], threshold: float = 0.05
) -> DataFrame:
    """``feature, ks_stat, n_ref, n_curr, p_value, drifted``: one row per feature."""
    return with_verdict(with_p_value(ks_statistic(reference, current, features)), threshold)


def drift_report_by_side(df: DataFrame, features: Sequence[str], side: str, threshold: float = 0.05) -> DataFrame:
    """The same for one table whose boolean column ``side`` marks the reference rows; scans it once."""
    return with_verdict(with_p_value(ks_by_side(df, features, side)), threshold)


def drifted_features(report: DataFrame) -> DataFrame:
    return report.where("drifted").select("feature", "ks_stat", "p_value")


def drift_metrics(report: DataFrame) -> DataFrame:
    """``key, value`` rows to record: both results per feature and the number of drifted features."""
    per_feature = report.select(F.inline(F.array(
        F.struct(F.concat(F.lit("drift_ks_"), "feature").alias("key"), F.col("ks_stat").alias("value")),
        F.struct(F.concat(F.lit("drift_pval_"), "feature").alias("key"), F.col("p_value").alias("value")),
    )))
    total = report.agg(F.count_if("drifted").cast("double").alias("value"))
    return per_feature.unionAll(total.select(F.lit("n_drifted_features").alias("key"), "value"))
