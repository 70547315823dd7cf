"""Counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_count(df: DataFrame, where: Column | None = None, name: str = "n") -> DataFrame:
    """One row: all rows, or those meeting ``where``."""
    measure = F.count(F.lit(1)) if where is None else F.count_if(where)
    return df.agg(measure.alias(name))


def value_counts(df: DataFrame, column: str, by_frequency: bool = False) -> DataFrame:
    """Frequency of each value, ordered by value or by descending frequency; missing values dropped."""
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        df = df.select(F.when(~F.isnan(column), F.col(column)).alias(column))
    # Counting the column leaves its NULL group at 0, to drop after the aggregate: a filter before it
    # would compute a derived column twice.
    counts = df.groupBy(column).agg(F.count(column).alias("n")).where(F.col("n") > 0)
    return counts.orderBy(F.desc("n"), column) if by_frequency else counts.orderBy(column)
