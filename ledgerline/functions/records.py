"""Rows as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_json(columns: Sequence[str | Column]) -> Column:
    """Compact JSON object with one field per column, in the given order. NULLs stay as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def list_text(items: Column) -> Column:
    """The array's elements, comma-joined without brackets. NULL elements are skipped, a NULL array stays NULL."""
    return F.array_join(items, ",")
