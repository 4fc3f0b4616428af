"""Catalog tables: replace and append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, by name, in its order and types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def replace_table(df: DataFrame, table: str, schema: T.StructType | None = None, sort_by: str | None = None) -> DataFrame:
    """Create or replace ``table``. Sorting happens inside each file only: it helps readers skip, costs no
    shuffle, and no more is observable in a table."""
    df = conform(df, schema) if schema else df
    df = df.sortWithinPartitions(sort_by) if sort_by else df
    df.write.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(table)
    return df.sparkSession.table(table)


def create_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Create or replace an empty ``table``."""
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(table)


def append(df: DataFrame, table: str) -> DataFrame:
    """Append by position: the n-th column goes into the table's n-th column, whatever it is called."""
    target = df.sparkSession.table(table).schema
    if len(df.columns) != len(target):
        raise ValueError(f"{table} has {len(target)} columns, got {len(df.columns)}")
    df.write.insertInto(table)
    return df.sparkSession.table(table)
