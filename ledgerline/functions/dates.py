"""Dates written as eight digits, with ``'0'`` standing for "none"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the register writes dates.
NO_DATE = "0"
DATE_FORMAT = "yyyyMMdd"


def parse_date(text: Column, guard: Column | None = None) -> Column:
    """The date in ``text``, NULL where it does not parse or where ``guard`` (default: ``text``) says none."""
    guard = text if guard is None else guard
    return F.when(guard == NO_DATE, F.lit(None).cast("date")).otherwise(F.try_to_date(text, DATE_FORMAT))


def strict_date(text: Column) -> Column:
    """Cast to date. Text that is no date fails the job, whatever the session's ANSI setting."""
    parsed = text.try_cast("date")
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")).otherwise(parsed)
