"""Compressed CSV shards for another system to load, and reading them back as one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schemas import text_schema

# NULL is written as nothing and '' as "", and read back so. Blanks are data.
SHARD_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# gzip cannot be split when read, so shards stay small.
SHARD_ROWS = 1_000_000


def export_csv(df: DataFrame, path: str, shard_rows: int = SHARD_ROWS) -> str:
    """Replace what is at ``path`` by gzip CSV shards, each starting with a header line."""
    (
        df.write.mode("overwrite")
        .options(**SHARD_OPTIONS, header="true", compression="gzip", maxRecordsPerFile=str(shard_rows))
        .csv(path)
    )
    return path


def read_as_one(spark: SparkSession, path: str, columns) -> DataFrame:
    """All shards as one file laid end to end, by position and as text: header lines come along as rows.

    Line breaks inside quotes are data. A record without exactly these columns fails the query that reads it.
    """
    # A gzip shard is read by one task whether or not records may span lines.
    modes = {"header": "false", "nullValue": "\x01", "multiLine": "true", "mode": "FAILFAST", "columnPruning": "false"}
    return spark.read.schema(text_schema(columns)).options(**SHARD_OPTIONS, **modes).csv(path)
