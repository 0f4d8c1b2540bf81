"""Row filters, null-safe where the meaning asks for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column holds the value; null never does."""
    return df.where(F.col(column) == value)


def differs(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column holds anything but the value, null included."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is neither null nor the empty string."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))
