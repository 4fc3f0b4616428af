"""Exported shards → all-text staging → typed table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import strict_date
from ledgerline.operators.filters import data_rows
from ledgerline.operators.keys import insert_if_absent, one_per_key, one_per_key_of_few
from ledgerline.schemas import WIDE, WIDE_DATES
from ledgerline.sinks.export import read_as_one

KEY = "cnpj"


def stage(spark: SparkSession, path: str) -> DataFrame:
    """The export at ``path`` as text, header lines included."""
    return read_as_one(spark, path, WIDE)


def typed(staged: DataFrame, existing: DataFrame | None = None, copies: bool = False, stored: bool = False) -> DataFrame:
    """Staged rows without header lines and keyless rows, dates cast, one row per key.

    Picking one row per key also removes exact duplicates. With ``existing`` its rows win over new ones. Without it,
    ``copies`` adds how many staged rows each row stands for. Rows that are ``stored`` as columns are read twice, so that only
    those whose key may repeat are shuffled.
    """
    rows = data_rows(staged, KEY).select(
        *(strict_date(F.col(c)).alias(c) if c in WIDE_DATES else F.col(c) for c in staged.columns)
    )
    if existing is not None:
        return insert_if_absent(existing, rows, KEY)
    return one_per_key_of_few(rows, KEY, copies) if stored else one_per_key(rows, KEY, copies)
