"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def data_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set and is not the column's own name: header lines left between joined shards go."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != key))


def where_equal(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows equal to every value given; ``None`` means "not asked for". No value, no filter."""
    conditions = [F.col(column) == F.lit(value) for column, value in wanted.items() if value is not None]
    return df.where(reduce(Column.__and__, conditions)) if conditions else df
