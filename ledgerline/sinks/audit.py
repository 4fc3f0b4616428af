"""Ingest audit: which file arrived when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_ZONE = "America/Sao_Paulo"

AUDIT = T.StructType(
    [T.StructField("file_name", T.StringType()), T.StructField("download_timestamp", T.TimestampType())]
)


def local_wall_clock(moment: Column) -> Column:
    """The local time of day at ``moment``, kept as if it were UTC."""
    return F.from_utc_timestamp(moment, LOCAL_ZONE)


def audit_rows(files: DataFrame, file_name: Column, moment: Column | None = None) -> DataFrame:
    """One audit row per file, at ``moment`` or now."""
    moment = F.current_timestamp() if moment is None else moment
    return files.select(
        file_name.alias("file_name"), local_wall_clock(moment).cast("timestamp").alias("download_timestamp")
    )
