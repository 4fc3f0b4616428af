"""Expressions and columns that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text, as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (in any case)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def document_keys(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs that tell documents apart by id and text. Rows that agree in both are one document."""
    one, two = F.col(doc_id).cast("string"), F.col(text)
    return [
        F.xxhash64(F.lit(1), one, one.isNull(), two, two.isNull()).alias("d1"),
        F.xxhash64(F.lit(2), two, one).alias("d2"),
    ]


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that no other column of ``docs`` can clash with an operator's own."""
    return docs.select(*(F.col(f"`{c}`") for c in columns))
