"""Column expressions shared by the operators: missing values, checks and repeatable hashes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX_WORD = 15  # 60 bits, the most hexadecimal digits a signed bigint holds


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every absent column. Reads the schema only."""
    wanted, present = list(names), df.columns
    absent = [name for name in wanted if name not in set(present)]
    if absent:
        raise ValueError(f"Columns {absent} are needed, the table has {present}")


def as_double(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("double")


def is_missing(column: Column | str) -> Column:
    """True for NULL and for NaN; never NULL itself."""
    value = as_double(column)
    return value.isNull() | F.isnan(value)


def nan_to_null(column: Column | str) -> Column:
    value = as_double(column)
    return F.when(~F.isnan(value), value)


def any_missing(columns: Sequence[Column | str]) -> Column:
    flag = is_missing(columns[0])
    for column in columns[1:]:
        flag = flag | is_missing(column)
    return flag


def reject_missing(df: DataFrame, features: Sequence[str], what: str) -> DataFrame:
    """Cast ``features`` to double and fail the job at the first NULL or NaN, without a second pass."""

    def checked(name: str) -> Column:
        message = F.lit(f"{what}: missing value in column {name}")
        return F.when(is_missing(name), F.raise_error(message).cast("double")).otherwise(as_double(name))

    return df.withColumns({name: checked(name) for name in features})


def key_digest(keys: Sequence[str], seed: int = 0) -> Column:
    """MD5 of the key columns and a seed: the same on every partitioning and in other SQL engines."""
    parts = [F.col(key).cast("string") for key in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def digest_word(digest: Column, first: int = 1, digits: int = HEX_WORD) -> Column:
    """``digits`` hexadecimal digits of a digest, from 1-based position ``first``, as a bigint."""
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("bigint")
