"""Folding each company's rows into arrays of JSON records, complete or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.records import row_json
from ledgerline.operators.joins import measure

KEY = "cnpj_basico"
FOLDED = "socios_json"

# The most text one row may hold, the row limit of the warehouse the published table was designed for.
# No company of the register comes near it; one that does cannot be folded into a row there at all.
MAX_CELL_BYTES = 100_000_000
# Text per array of the layout in parts, about.
PART_BYTES = 16_000_000
# Keys an error names.
NAMED_KEYS = 20


class OversizeError(ValueError):
    """Companies whose records do not fit one row."""


def _record(columns: Sequence[str]) -> Column:
    return row_json(columns).alias("record")


def record_bytes(columns: Sequence[str], text: int, rows: int) -> int:
    """Upper bound of the JSON text of ``rows`` records with ``text`` bytes in them, without writing JSON: a byte takes
    six at most when escaped, and a field as many more as its name, quotes, colon, comma and ``null`` do."""
    return 6 * text + rows * (sum(len(c) + 10 for c in columns) + 3)


def oversize_keys(rows: DataFrame, columns: Sequence[str], max_bytes: int = MAX_CELL_BYTES) -> DataFrame:
    """Keys whose records take more than ``max_bytes`` together, and the bytes. Sums before it shuffles."""
    records = rows.select(KEY, _record(columns))
    size = F.sum(F.octet_length("record").cast("long") + 1)
    return records.groupBy(KEY).agg(size.alias("bytes")).where(F.col("bytes") > max_bytes)


def fold(
    rows: DataFrame, columns: Sequence[str], max_bytes: int = MAX_CELL_BYTES, bound: int | None = None
) -> DataFrame:
    """``(cnpj_basico, socios_json)``: a JSON object of ``columns`` for each row, all of a key in one array.

    NULL is a key like any other. The order inside the array is open in the original; here it is sorted. No array
    is collected that was not measured to fit: a key with more than ``max_bytes`` is an :class:`OversizeError` that
    names it, before anything is folded; :func:`fold_in_parts` takes keys of any size. ``bound`` is an upper bound
    of a key's bytes where one is known already.
    """
    if bound is None:
        measured = measure(rows.select(KEY, *(c for c in columns if c != KEY)))[0]
        bound = record_bytes(columns, measured.key_text, measured.key_rows)
    if bound > max_bytes:
        over = oversize_keys(rows, columns, max_bytes).orderBy(F.desc("bytes"), KEY).limit(NAMED_KEYS).collect()
        if over:
            named = ", ".join(f"{r[KEY]} ({r['bytes']} bytes)" for r in over)
            raise OversizeError(f"more than {max_bytes} bytes of records: {named}; fold_in_parts takes them")
    # Arrays are as large before the shuffle as after it, so records go first and are collected once.
    records = rows.select(KEY, _record(columns)).repartition(KEY)
    return records.groupBy(KEY).agg(F.sort_array(F.collect_list("record")).alias(FOLDED))


def fold_in_parts(rows: DataFrame, columns: Sequence[str], part_bytes: int = PART_BYTES) -> DataFrame:
    """``(cnpj_basico, part, socios_json)``: the same records with a key's arrays cut into parts, for all keys alike.

    Every record is in one part. A part holds records of one key and one input partition, cut whenever their running
    bytes pass ``part_bytes``, so no array is larger than that and one record, however often a record repeats. Parts of
    a key have different numbers, with gaps.
    """
    records = rows.select(KEY, _record(columns), F.spark_partition_id().alias("piece"))
    sized = records.withColumn("bytes", F.octet_length("record").cast("long") + 1)
    before = Window.partitionBy(KEY, "piece").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    cut = F.floor(running / F.lit(part_bytes)).cast("long")
    numbered = sized.withColumn("part", F.shiftleft(F.col("piece").cast("long"), 32) + cut)
    return numbered.groupBy(KEY, "part").agg(F.sort_array(F.collect_list("record")).alias(FOLDED))
