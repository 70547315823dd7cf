"""Standardising features with parameters that can be stored and applied later."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segwatch.functions.columns import as_double, nan_to_null, require_columns
from segwatch.functions.storage import local_table

SCALER_SCHEMA = "feature string, position int, mean double, std double, scale double"

# Spread relative to the mean below which a column is rounding noise, whatever the number of rows.
CONSTANT_SPREAD = 1e-12


@dataclass(frozen=True)
class Scaler:
    """Mean, population standard deviation and divisor of each feature, in feature order."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]
    scales: tuple[float, ...]

    def column(self, feature: str) -> Column:
        i = self.features.index(feature)
        return (as_double(feature) - F.lit(self.means[i])) / F.lit(self.scales[i])

    def columns(self) -> dict[str, Column]:
        return {feature: self.column(feature) for feature in self.features}

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (name, i, self.means[i], self.stds[i], self.scales[i])
            for i, name in enumerate(self.features)
        ]
        return local_table(spark, rows, SCALER_SCHEMA)

    @classmethod
    def from_table(cls, table: DataFrame) -> Scaler:
        """Read back the one-row-per-feature table of a single run."""
        rows = table.select("feature", "mean", "std", "scale").orderBy("position").collect()
        if not rows:
            raise LookupError("No scaler parameters stored for this run")
        return cls(*(tuple(column) for column in zip(*rows)))


def column_moments(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, non-missing values, mean and population standard deviation per feature.

    One aggregate over the needed columns only, combined on the map side, then one row per feature
    (and per group of ``by``). NULL and NaN are ignored.
    """
    require_columns(df, [*features, *by])
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(features):
        value = nan_to_null(name)
        measures += [
            F.count(value).alias(f"n_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_pop(value).alias(f"std_{i}"),
        ]
    one_row = df.groupBy(*by).agg(*measures)
    per_feature = F.array(*(
        F.struct(
            F.lit(name).alias("feature"),
            F.lit(i).alias("position"),
            F.col(f"n_{i}").alias("n"),
            F.col(f"mean_{i}").alias("mean"),
            F.col(f"std_{i}").alias("std"),
        )
        for i, name in enumerate(features)
    ))
    return one_row.select(*by, "n_rows", F.inline(per_feature))


def with_scale(moments: DataFrame) -> DataFrame:
    """Add the divisor: the standard deviation, or 1 where the column is constant.

    Constant means a deviation of at most ``CONSTANT_SPREAD`` times the mean. Public standard scalers use
    the rounding error of summing the rows, which grows with their number and agrees at about 4 500 rows.
    """
    constant = F.col("std") <= CONSTANT_SPREAD * F.abs("mean")
    return moments.withColumn("scale", F.when(constant, F.lit(1.0)).otherwise(F.col("std")))


def fit_scaler(df: DataFrame, features: Sequence[str], allow_missing: bool = True) -> Scaler:
    """Fit on ``df``. Only one row per feature comes back to the driver."""
    rows = with_scale(column_moments(df, features)).orderBy("position").collect()
    if rows[0]["n_rows"] == 0:
        raise ValueError("Cannot fit a scaler on an empty table")
    holes = {r["feature"]: r["n_rows"] - r["n"] for r in rows if r["n"] < r["n_rows"]}
    if holes and not allow_missing:
        raise ValueError(f"Missing values per column: {holes}")
    for r in rows:
        if r["mean"] is None or not math.isfinite(r["std"]):
            raise ValueError(f"Column {r['feature']} has no finite mean and deviation")
    return Scaler(
        tuple(features),
        tuple(r["mean"] for r in rows),
        tuple(r["std"] for r in rows),
        tuple(r["scale"] for r in rows),
    )


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Replace the features by their standardised values; all other columns stay."""
    require_columns(df, scaler.features)
    return df.withColumns(scaler.columns())


def scale_features(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, Scaler]:
    scaler = fit_scaler(df, features)
    return apply_scaler(df, scaler), scaler
